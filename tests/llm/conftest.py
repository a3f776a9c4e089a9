import re

import pytest

from tests.conftest import SMALL


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def frame(spark, rows, schema="doc_id long, text string, source string"):
    """Rows of (doc_id, text[, ...]) with a further column, as a table the operators must accept."""
    width = schema.count(",") + 1
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
