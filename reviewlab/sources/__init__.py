"""Scans, sinks and the stand-in review tables built from the driver tables."""

from reviewlab.sources.io import (  # noqa: F401
    RAW_SCHEMA, read_table, read_reviews_tsv, read_csv, write_csv, write_parquet,
)
from reviewlab.sources import fixtures  # noqa: F401
