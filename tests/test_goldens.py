"""Worked examples from the reference's docstrings (FIXTURES.md part B)."""

import numpy as np
from pyspark.sql import functions as F

from riskspark.operators import encode, profile
from riskspark.operators.clean import FeatureColumn, FeatureLayout
from riskspark.operators.gd import batch_schedule
from riskspark.operators.recode import apply_rules
from riskspark.sources.spec import spec_from_list


def test_one_hot_golden(spark):
    df = spark.createDataFrame([(0, 2.0), (1, 1.0), (2, 3.0)], "id int, c double")
    out = df.select("id", *encode.onehot_exprs("c", [1.0, 2.0, 3.0])).orderBy("id").collect()
    assert [tuple(r)[1:] for r in out] == [(0.0, 1.0, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0)]


def test_rule_order_matters(spark):
    df = spark.createDataFrame([(0, None), (1, 7.0)], "id int, c double").withColumn("split", F.lit("train"))
    a = spec_from_list([{"id": "c", "description": "", "type": "continuous", "mapping": [["NaN", "2"], ["7", "NaN"]]}])[0]
    b = spec_from_list([{"id": "c", "description": "", "type": "continuous", "mapping": [["7", "NaN"], ["NaN", "2"]]}])[0]
    ra = [r["c"] for r in apply_rules(df, {"c": a.mapping})[0].orderBy("id").collect()]
    rb = [r["c"] for r in apply_rules(df, {"c": b.mapping})[0].orderBy("id").collect()]
    assert ra == [2.0, None]
    assert rb == [2.0, 2.0]


def test_mean_then_range(spark):
    rows = [(0, None), (1, 60.0), (2, 20.0), (3, 100.0), (4, 50.0)]
    df = spark.createDataFrame(rows, "id int, c double").withColumn("split", F.lit("train"))
    s = spec_from_list([{"id": "c", "description": "", "type": "continuous",
                         "mapping": [["NaN", "mean"], ["50-100", "2"]]}])[0]
    out = [r["c"] for r in apply_rules(df, {"c": s.mapping})[0].orderBy("id").collect()]
    # mean of (60, 20, 100, 50) = 57.5 -> inside [50, 100] -> 2
    assert out == [2.0, 2.0, 20.0, 2.0, 2.0]


def test_layout_degree_two():
    lay = FeatureLayout([FeatureColumn("x1", "continuous", "x1"), FeatureColumn("x2", "continuous", "x2"),
                         FeatureColumn("x3", "continuous", "x3"), FeatureColumn("cat1", "onehot", "c", 1.0),
                         FeatureColumn("cat2", "onehot", "c", 2.0)])
    assert lay.expanded(2).names == ["x1", "x1_p2", "x2", "x2_p2", "x3", "x3_p2", "cat1", "cat2"]


def test_powers(spark):
    df = spark.createDataFrame([(2.0, 3.0), (4.0, 5.0)], "a double, b double")
    out = [tuple(r) for r in df.select(*encode.poly_exprs(["a", "b"], 2)).collect()]
    assert out == [(2.0, 4.0, 3.0, 9.0), (4.0, 16.0, 5.0, 25.0)]


def test_sparse_column_dropped(spark):
    rows = [(i, "train", None if i < 15 else 1.0, 1.0) for i in range(100)]
    rows += [(100 + i, "test", 1.0, 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, split string, a double, b double")
    rep = profile.sparse_column_report(df, ["a", "b"], 0.1)
    assert profile.kept_columns(rep, ["a", "b"]) == ["b"]


def test_constant_column_dropped(spark):
    df = spark.createDataFrame([(5.0, float(i)) for i in range(10)], "a double, b double")
    rep = {r["feature"]: r["kept"] for r in profile.constant_report(df, ["a", "b"]).collect()}
    assert rep == {"a": False, "b": True}


def test_batch_schedule_no_shuffle():
    # N=45, size 7 -> 6 whole batches; 9 steps start at 0,7,14,21,28,35,0,7,14
    starts = [b * 7 for b in batch_schedule(9, 45 // 7)]
    assert starts == [0, 7, 14, 21, 28, 35, 0, 7, 14]


def test_submission_csv(spark, tmp_path):
    from riskspark.sources.sink import write_submission
    df = spark.createDataFrame([(1, -1), (2, 1), (3, 1)], "Id bigint, Prediction int")
    path = write_submission(df, str(tmp_path))
    back = spark.read.option("header", True).csv(path).orderBy(F.col("Id").cast("int")).collect()
    assert [(r["Id"], r["Prediction"]) for r in back] == [("1", "-1"), ("2", "1"), ("3", "1")]
    assert "submission_" in path


def test_submission_rejects_other_values(spark, tmp_path):
    import pytest
    from riskspark.sources.sink import write_submission
    df = spark.createDataFrame([(1, 0)], "Id bigint, Prediction int")
    with pytest.raises(ValueError):
        write_submission(df, str(tmp_path))
