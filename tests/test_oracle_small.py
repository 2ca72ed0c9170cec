"""Registered queries against their DuckDB SQL at sf0.001 (fast subset)."""

import math

import duckdb
import pytest

import __spark_entry__ as ent
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
FAST = ["null_profile", "drop_sparse_columns", "spec_conformance", "vocab_conformance", "recode_chain",
        "range_bin", "impute_mean_per_split", "auto_type", "auto_vocab", "one_hot", "drop_constant",
        "poly_expand", "add_intercept", "stride_sample", "holdout_split", "kfold_assign", "exact_holdout",
        "undersample", "scale_fit", "scale_apply_kfold", "class_ratio", "label_counts", "mse_loss",
        "logistic_balanced_gradient", "gram_matrix", "least_squares", "ridge", "mse_gd", "logistic_gd",
        "minibatch_gd", "confusion_metrics", "threshold_search", "cross_validate", "fold_average",
        "holdout_metrics", "submission", "label_correlation", "split_scale", "clean_snapshot", "ridge_score",
        "doc_cross_validate", "event_scale_fit", "csv_load", "exact_stride_sample", "minibatch_gd_exact",
        "kfold_exact", "minibatch_gd_shuffled", "model_scores"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return repr(v)


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, con, name):
    sdf = ent.queries()[name](spark, SF_SMALL)
    res = con.sql(ent.oracle_sql()[name])
    assert sorted(c.lower() for c in sdf.columns) == sorted(c.lower() for c in res.columns)
    assert _canon([tuple(r) for r in sdf.collect()], sdf.columns) == _canon(res.fetchall(), res.columns)


def test_every_query_has_oracle():
    from riskspark.queries import catalog
    assert set(catalog.QUERIES) <= set(ent.oracle_sql())
    assert set(catalog.QUERIES) <= set(ent.queries())


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() == 5
    assert "f1" in df.columns
