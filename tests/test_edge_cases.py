"""Edge cases (FIXTURES.md part C)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.functions.columns import bucket_of_score, threshold_grid
from riskspark.operators import conform, evaluate, linear, profile
from riskspark.operators.gd import negative_positive_ratio
from riskspark.sources.spec import spec_from_list


def test_junk_csv_cell_is_null(spark, tmp_path):
    from riskspark.sources.csv_source import load_csv_data
    (tmp_path / "x_train.csv").write_text("Id,a,b\n1,1.5,x\n2,,3\n")
    (tmp_path / "x_test.csv").write_text("Id,a,b\n9,2.5,4\n10,NaN,4\n")
    (tmp_path / "y_train.csv").write_text("Id,Prediction\n1,1\n2,-1\n")
    df = load_csv_data(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r["id"], r["split"], r["label"], r["a"], r["b"]) for r in df] == [
        (1, "train", 1, 1.5, None), (2, "train", -1, None, 3.0), (9, "test", None, 2.5, 4.0),
        (10, "test", None, None, 4.0)]


def test_vocabulary_violation_names_values(spark):
    df = spark.createDataFrame([("train", 1.0), ("test", 4.0), ("test", None)], "split string, c double")
    with pytest.raises(ValueError, match="4.0"):
        conform.check_vocabulary(df, "c", [1.0, 2.0])
    conform.check_vocabulary(df.filter("c IS NULL OR c = 1.0"), "c", [1.0, None])


def test_auto_threshold_ten_vs_eleven(spark):
    ten = [(float(i % 9),) for i in range(50)] + [(None,)]
    eleven = [(float(i % 10),) for i in range(50)] + [(None,)]
    df10 = spark.createDataFrame(ten, "c double")
    df11 = spark.createDataFrame(eleven, "c double")
    assert profile.auto_kinds(df10, ["c"]).first()["kind"] == "categorical"
    assert profile.auto_kinds(df11, ["c"]).first()["kind"] == "continuous"


def test_missing_ratio_exactly_threshold_is_kept(spark):
    rows = [("train", None if i == 0 else 1.0) for i in range(10)] + [("test", 1.0)]
    df = spark.createDataFrame(rows, "split string, c double")
    assert profile.kept_columns(profile.sparse_column_report(df, ["c"], 0.1), ["c"]) == ["c"]


def test_score_equal_threshold_is_negative(spark):
    df = spark.createDataFrame([(0.5,), (0.6,), (None,)], "s double")
    out = [r[0] for r in df.select(evaluate.predict(F.col("s"), 0.5)).collect()]
    assert out == [-1, 1, 1]


def test_bucket_matches_grid_count(spark):
    n = 100
    grid = threshold_grid(n)
    vals = [-2.0, -1.0, 1.0, 2.0, 0.0] + grid[:10] + [g + 1e-12 for g in grid[40:50]] + list(np.linspace(-1, 1, 37))
    df = spark.createDataFrame([(float(v),) for v in vals], "s double")
    got = [r[0] for r in df.select(bucket_of_score(F.col("s"), n)).collect()]
    assert got == [sum(1 for t in grid if t < v) for v in vals]


def _search(spark, rows, n=100):
    df = spark.createDataFrame(rows, "score double, label int")
    r = evaluate.threshold_search(df, "score", "label", n).first()
    return r["threshold"], r["f1"]


def test_search_all_zero_f1_gives_zero(spark):
    assert _search(spark, [(2.0, -1), (3.0, -1)]) == (0.0, 0.0)


def test_search_ties_take_lower_threshold(spark):
    # every grid threshold in [-0.9, 0.9) separates the two rows; the first one wins
    t, f1 = _search(spark, [(0.9, 1), (-0.9, -1)])
    grid = threshold_grid(100)
    first = min(i for i, g in enumerate(grid) if g >= -0.9)
    assert f1 == 1.0 and t == grid[first]


def test_single_threshold_grid():
    assert threshold_grid(1) == [-1.0]


def test_no_positive_predictions():
    m = evaluate.metrics_np(0, 5, 5, 0)
    assert m["precision"] == 0.0 and m["f1"] == 0.0


def test_class_ratio_edges():
    assert negative_positive_ratio(0, 5) == 1.0
    with pytest.raises(ValueError):
        negative_positive_ratio(5, 0)


def test_sigma_zero_scales_to_zero():
    from riskspark.plans.cv import scaler_affine
    a, c = scaler_affine(3, [1, 2], np.array([5.0, 1.0]), np.array([0.0, 2.0]))
    assert (a[1], c[1]) == (0.0, 0.0) and (a[2], c[2]) == (0.5, -0.5)


def test_logistic_loss_large_t_finite(spark):
    from riskspark.functions.columns import softplus
    v = spark.range(1).select(softplus(F.lit(800.0)).alias("v")).first()["v"]
    assert v == 800.0


def test_singular_least_squares_raises_ridge_works():
    G = np.array([[1.0, 1.0], [1.0, 1.0]])
    b = np.array([1.0, 1.0])
    with pytest.raises(np.linalg.LinAlgError):
        linear.least_squares(G, b)
    assert np.all(np.isfinite(linear.ridge(G, b, 2.0, 0.1)))


def test_folds_cover_every_row_once(spark):
    from riskspark.operators.split import fold_column
    df = spark.range(10).withColumn("fold", fold_column(3, 1, "id"))
    assert df.count() == 10
    assert set(r["fold"] for r in df.collect()) <= {0, 1, 2}


def test_spec_parsing():
    s = spec_from_list([{"id": "a", "description": "", "type": "categorical", "vocabulary": ["2", "1", "NaN"],
                         "mapping": [["-5--1", "0"], ["NaN", "mean"]]}])[0]
    assert s.vocabulary == [1.0, 2.0, None]
    assert (s.mapping[0].kind, s.mapping[0].lo, s.mapping[0].hi) == ("range", -5.0, -1.0)
    with pytest.raises(ValueError):
        spec_from_list([{"id": "a", "description": "", "type": "bogus"}])


def test_unmatched_ids_and_results_writer(spark, tmp_path):
    from riskspark.sources.csv_source import unmatched_ids
    from riskspark.sources.sink import write_results
    (tmp_path / "x_train.csv").write_text("Id,a\n1,1.0\n2,2.0\n")
    (tmp_path / "x_test.csv").write_text("Id,a\n9,2.5\n")
    (tmp_path / "y_train.csv").write_text("Id,Prediction\n1,1\n3,-1\n")
    got = sorted((r["id"], r["missing"]) for r in unmatched_ids(spark, str(tmp_path)).collect())
    assert got == [(2, "label"), (3, "features")]
    grid = spark.createDataFrame([(0.1, 0.5), (0.7, 0.6)], "gamma double, f1 double")
    write_results(grid, str(tmp_path / "sweep"))
    assert spark.read.option("header", True).csv(str(tmp_path / "sweep")).count() == 2


def test_exact_rank_boundary_matches_sort(spark):
    from riskspark.operators.split import boundary_flag, rank_boundary
    from riskspark.functions.hashing import hash32
    df = spark.range(5000).withColumn("__h", hash32("t", "id"))
    rows = sorted((r["__h"], r["id"]) for r in df.collect())
    for m in (0, 1, 777, 4999, 5000):
        flag = boundary_flag(rank_boundary(df, m, "__h", "id"), "__h", "id")
        picked = sorted((r["__h"], r["id"]) for r in df.filter(flag).collect())
        assert picked == rows[:m]


def test_missing_left_in_continuous_column_is_an_error(spark):
    from riskspark.operators.clean import CleaningEstimator
    rows = [(i, "train" if i < 40 else "test", 1 if i % 3 else -1, float(i) if i % 17 else None) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, split string, label int, a double")
    spec = spec_from_list([{"id": "a", "description": "", "type": "continuous"}])
    with pytest.raises(ValueError, match="still have missing"):
        CleaningEstimator(spec).fit(df)
    model = CleaningEstimator(spec, on_missing="keep").fit(df)
    assert model.layout.names == ["a"]
    imputed = spec_from_list([{"id": "a", "description": "", "type": "continuous", "mapping": [["NaN", "mean"]]}])
    assert CleaningEstimator(imputed).fit(df).transform(df).filter("a IS NULL").count() == 0


def test_exact_rank_equals_sorted_position(spark):
    from riskspark.functions.hashing import hash32
    from riskspark.operators.split import exact_rank
    df = spark.range(3000).repartition(5)
    ranked = {r["id"]: r["rank"] for r in exact_rank(df, "t", "id", partitions=7).collect()}
    order = [r["id"] for r in df.withColumn("h", hash32("t", "id")).orderBy("h", "id").collect()]
    assert [ranked[i] for i in order] == list(range(3000))
