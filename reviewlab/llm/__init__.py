"""Training-data operators: archives, deduplication, language, licences, toxicity, tokens.

Every operator takes and returns DataFrames.  Nothing else in the library
imports this subpackage; ``__spark_entry__`` adds its queries when it is there.
"""
