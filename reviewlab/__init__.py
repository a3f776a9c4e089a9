"""reviewlab: review-table analytics expressed as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or a small result
DataFrame for model statistics).  Heavy work stays inside Spark: joins,
windows, grouped aggregates and, where numpy is genuinely needed, grouped
``applyInPandas`` over bounded blocks.
"""

__version__ = "0.1.0"
