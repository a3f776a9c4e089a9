"""Text cleaning as native Column expressions (STR-1..11, FLT-1, STR-9).

Nothing here is a Python UDF: every function builds a Catalyst expression, so
cleaning runs inside whole-stage codegen on the executors.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour:
# ASCII punctuation (Python's string.punctuation) plus newline and tab; these
# characters are deleted, not replaced by a space.
PUNCTUATION = string.punctuation + "\n\t"
# The HTML apostrophe residue in review text and its replacement.
RESIDUE, RESIDUE_REPLACEMENT = "039", "'"
# Marker text that means "not a condition".
HELPFUL_MARKER = "users found this comment helpful"
# Conditions that are never searched for in review text.
EXCLUDED_CONDITIONS = ("eve", "me")

# Whitespace exactly as Python's str.split() sees it (Java regex syntax).
WS_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
WS_RUN = WS_CLASS + "+"
NON_WS_RUN = "[^" + WS_CLASS[1:] + "+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower(c) -> Column:
    """STR-1."""
    return F.lower(_c(c))


def replace_residue(c) -> Column:
    """STR-2: '039' -> apostrophe."""
    return F.replace(_c(c), F.lit(RESIDUE), F.lit(RESIDUE_REPLACEMENT))


def collapse_whitespace(c) -> Column:
    """STR-3: ``" ".join(text.split())``."""
    return F.trim(F.regexp_replace(_c(c), WS_RUN, " "))


def strip_punctuation(c) -> Column:
    """STR-4: delete punctuation, newline and tab."""
    return F.translate(_c(c), PUNCTUATION, "")


def clean_review(c) -> Column:
    """STR-5: lower -> residue -> whitespace -> punctuation; null passes."""
    return strip_punctuation(collapse_whitespace(replace_residue(lower(c))))


def clean_text(c) -> Column:
    """STR-6: lower -> punctuation; null passes."""
    return strip_punctuation(lower(c))


def word_count(c) -> Column:
    """STR-7: ``len(str(x).split())``; a null counts as one word ('nan')."""
    c = _c(c)
    # pieces between whitespace runs, less the empty piece a leading or
    # trailing run leaves; an all-whitespace (or empty) text has no words
    pieces = F.size(F.split(c, WS_RUN))
    one = "^" + WS_CLASS + "$"
    edges = F.substring(c, 1, 1).rlike(one).cast("int") + F.substring(c, -1, 1).rlike(one).cast("int")
    n = F.when(c.rlike("^" + WS_CLASS + "*$"), F.lit(0)).otherwise(pieces - edges)
    return F.when(c.isNull(), F.lit(1)).otherwise(n).cast("int")


def tokens(c) -> Column:
    """STR-11: ``text.split()`` as an array (no empty tokens)."""
    return F.filter(F.split(_c(c), WS_RUN), lambda w: w != F.lit(""))


def upper_word_count(c) -> Column:
    """STR-8: words with a cased character and no lower-case one (``isupper``)."""
    c = _c(c)
    words = tokens(c)
    n = F.size(F.filter(words, lambda w: (w == F.upper(w)) & (w != F.lower(w))))
    return F.when(c.isNull(), F.lit(0)).otherwise(n).cast("int")


def is_marker(c, marker: str = HELPFUL_MARKER) -> Column:
    """STR-9: substring test, null -> false."""
    return F.coalesce(_c(c).contains(marker), F.lit(False))


def condition_pattern(cond) -> Column:
    """STR-10: ``[^a-z]`` + escaped literal + ``[^a-z|s]`` as a Java regex."""
    # a literal that holds the end mark itself is quoted in two parts around it
    literal = F.replace(_c(cond), F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit("[^a-z]\\Q"), literal, F.lit("\\E[^a-z|s]"))
