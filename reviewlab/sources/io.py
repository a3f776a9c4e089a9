"""SRC-1..3: tab/comma separated scans with explicit schemas, and sinks.

Schemas are always given at the scan (no inference pass over 100 TB), and the
Parquet reader is used for every stage hand-off so later scans get column
pruning and predicate pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Raw review layout (header row present; first column is the row id).
RAW_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("drugName", T.StringType()),
    T.StructField("condition", T.StringType()),
    T.StructField("review", T.StringType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("date", T.StringType()),
    T.StructField("usefulCount", T.IntegerType()),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (Parquet)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_reviews_tsv(spark: SparkSession, paths, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """SRC-1: tab-separated text with a header; reviews may span lines.

    A file whose records may span lines can't be split, so each is read by one task:
    a large corpus should come as many files, and is written as Parquet once.
    """
    return (spark.read.schema(schema)
            .option("sep", "\t").option("header", True)
            .option("multiLine", True).option("quote", '"').option("escape", '"')
            .option("mode", "FAILFAST")
            .csv(paths))


def read_csv(spark: SparkSession, paths, schema: T.StructType) -> DataFrame:
    """SRC-2: comma-separated file with a header row."""
    return (spark.read.schema(schema).option("header", True)
            .option("multiLine", True).option("escape", '"').option("mode", "FAILFAST").csv(paths))


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """SRC-3: header, no row index."""
    (df.write.mode("overwrite").option("header", True).option("sep", sep)
     .option("escape", '"').option("quoteAll", False).csv(path))


def write_parquet(df: DataFrame, path: str, partition_by=None) -> None:
    """Stage hand-off; partition only by low-cardinality columns."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
