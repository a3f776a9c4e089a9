"""A representative subset of registered queries against their DuckDB twins
on the smallest tables (the full set runs in scripts/check_oracle.py)."""

import duckdb
import pytest

from tests.conftest import SMALL

SUBSET = ["evt_features", "evt_drug_summary", "evt_folds", "evt_holdout_tail", "doc_clean_data",
          "doc_text_match", "doc_null_counts", "doc_feature_engineering", "scores_roc", "scores_auc",
          "scores_metrics", "li_vif", "li_ols_t", "li_ols_goodness", "emb_knn", "doc_knn_k_sweep",
          "doc_smote", "emb_silhouette", "emb_dbscan", "emb_outlier_labels", "doc_rules", "doc_lemmas",
          "doc_naive_bayes_fixed", "evt_tsv_roundtrip"]


@pytest.fixture(scope="module")
def con():
    from scripts.check_oracle import TABLES
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_duckdb(spark, con, name):
    import __spark_entry__ as E
    from scripts.check_oracle import digest, norm
    sdf = E.queries()[name](spark, SMALL).toPandas()
    odf = con.execute(E.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert digest(norm(sdf)) == digest(norm(odf))


def test_every_query_has_a_docstring_and_entry_runs(spark):
    import __spark_entry__ as E
    for name, fn in E.queries().items():
        assert fn.__doc__, name
    assert set(E.oracle_sql()) <= set(E.queries())
    rows = E.entry(spark).collect()
    assert len(rows) == 15 and all(v is not None for v in rows[0])
