"""What the entry module offers where the training-data subpackage can't be imported."""

import sys

import pytest


@pytest.fixture
def without(monkeypatch):
    """Makes modules unimportable and forgets what has been imported of the subpackage."""
    def make(*names):
        for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("reviewlab.llm")]:
            monkeypatch.delitem(sys.modules, name)
        package = sys.modules.get("reviewlab")
        if package is not None and hasattr(package, "llm"):
            monkeypatch.delattr(package, "llm")
        for name in names:
            monkeypatch.setitem(sys.modules, name, None)
    return make


@pytest.mark.parametrize("names", [("reviewlab.llm",), ("regex", "zstandard", "tokenizers", "pyarrow.fs")])
def test_other_queries_stay(without, names):
    import __spark_entry__ as entry
    from reviewlab.plans.catalog import ORACLE, QUERIES
    without("corpus_pipeline", *names)
    assert entry.queries() == QUERIES and entry.oracle_sql() == ORACLE


def test_queries_have_what_sql_names():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
