"""Wide scoring, exact ranks under any later plan, one-pass checks, loader and cleaning parameters."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.functions.columns import dot
from riskspark.operators import conform
from riskspark.operators.clean import CleaningEstimator, FeatureColumn, FeatureLayout
from riskspark.operators.gd import batch_starts, fit_minibatch, fit_minibatch_windows
from riskspark.operators.moments import gram_by_key
from riskspark.operators.split import exact_folds, exact_rank, rank_boundary
from riskspark.plans.methods import search_threshold
from riskspark.plans.models import LinearScorer
from riskspark.sources.csv_source import load_csv_data
from riskspark.sources.spec import FeatureSpec


def test_scoring_two_thousand_features(spark):
    width = 2000
    rng = np.random.default_rng(0)
    x, w = rng.standard_normal((3, width)), rng.standard_normal(width)
    rows = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(3)], "id long, a array<double>")
    wide = rows.select("id", *[F.col("a")[j].alias(f"f{j}") for j in range(width)])
    layout = FeatureLayout([FeatureColumn(f"f{j}", "continuous" if j % 2 else "onehot", f"f{j}") for j in range(width)])
    half = width // 2
    scorer = LinearScorer(layout, w, np.zeros(half), np.ones(half), False)
    got = {r["id"]: r["score"] for r in scorer.transform(wide).select("id", "score").collect()}
    assert np.allclose([got[i] for i in range(3)], x @ w)
    summed = wide.select("id", dot([f"f{j}" for j in range(width)], w).alias("s")).orderBy("id").collect()
    assert np.allclose([r["s"] for r in summed], x @ w)


def test_exact_rank_survives_later_plans(spark):
    df = spark.range(1000).withColumnRenamed("id", "key")
    ranked = exact_rank(df, "t", "key", partitions=16)
    for plan in (ranked, ranked.coalesce(1), ranked.coalesce(3), ranked.repartition(40)):
        assert sorted(r["rank"] for r in plan.select("rank").collect()) == list(range(1000))
    both = ranked.unionByName(exact_rank(df, "u", "key")).groupBy("rank").count()
    assert both.count() == 1000 and both.where("count = 2").count() == 1000
    assert "Python" not in ranked._jdf.queryExecution().toString() and "MapInArrow" not in ranked._jdf.queryExecution().toString()


def test_equal_keys_have_no_boundary(spark):
    with pytest.raises(ValueError, match="unique"):
        rank_boundary(spark.createDataFrame([(1, 5), (1, 5), (1, 6)], "__h int, id long"), 2)


def test_vocabulary_check_names_every_column_in_one_scan(spark):
    rows = [("train", f"v{i}", "x" if i else "odd") for i in range(200)] + [("test", None, "x")]
    df = spark.createDataFrame(rows, "split string, a string, b string")
    with pytest.raises(ValueError) as error:
        conform.check_vocabularies(df, {"a": ["v0"], "b": ["x"]})
    text = str(error.value)
    assert "a (train): 199 rows, 199 values" in text and "a (test): 1 rows" in text and "b (train): 1 rows, 1 values from 'odd'" in text
    plan = conform.vocabulary_report(df, {"a": ["v0"], "b": ["x"]})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_cleaning_uses_its_split_names(spark):
    rows = [(i, "fit", float(i % 3), float(i)) for i in range(60)] + [(100 + i, "hold", float(i), None) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, split string, c double, d double")
    model = CleaningEstimator([FeatureSpec("c", "auto"), FeatureSpec("d", "auto")], check_vocab=False,
                              train_value="fit", test_value="hold").fit(df)
    assert model.kinds == {"c": "categorical"} and len(model.vocabularies["c"]) == 40  # d is sparse in "hold"


def test_loader_reports_labels(spark, tmp_path):
    (tmp_path / "x_train.csv").write_text("Id,a\n1,2\n2,3\n")
    (tmp_path / "x_test.csv").write_text("Id,a\n3,4\n")
    (tmp_path / "y_train.csv").write_text("Id,y\n1,1\n")
    with pytest.raises(Exception, match="no label for id 2"):
        load_csv_data(spark, str(tmp_path)).collect()
    kept = {r["id"]: r["label"] for r in load_csv_data(spark, str(tmp_path), on_unlabelled="keep").collect()}
    assert kept == {1: 1, 2: None, 3: None}
    (tmp_path / "y_train.csv").write_text("Id,y\n1,1\n1,-1\n2,1\n")
    with pytest.raises(Exception, match="several labels for id 1"):
        load_csv_data(spark, str(tmp_path)).collect()


def test_threshold_search_without_points(spark):
    scored = spark.createDataFrame([(0.5, 1)], "score double, label int")
    assert search_threshold(scored, num_thresholds=0) == 0.0
    assert search_threshold(scored.limit(0)) == 0.0


def test_minibatch_trainer_collects_the_schedule_only(spark):
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(300), rng.standard_normal(300)])
    y, batch = x @ [0.5, -1.0] + rng.standard_normal(300) / 9, np.arange(300) // 10
    df = spark.createDataFrame([([float(v) for v in a], float(t), int(b)) for a, t, b in zip(x, y, batch)],
                               "x array<double>, y double, batch int")
    schedule = [3, 0, 3, 7]
    w = np.zeros(2)
    for b in schedule:
        part = batch == b
        w = w + 0.1 * x[part].T @ (y[part] - x[part] @ w) / part.sum()
    got, loss = fit_minibatch(df, 2, schedule, 0.1)
    assert np.allclose(got, w) and np.isclose(loss, ((y - x @ w) ** 2).mean() / 2)


def test_run_from_files(spark, tmp_path):
    import json

    from riskspark.plans.end_to_end import run_files
    rng = np.random.default_rng(2)
    a = rng.standard_normal(400)
    rows = [f"{i},{a[i]:.6f},{i % 3}" for i in range(400)]
    (tmp_path / "x_train.csv").write_text("Id,a,c\n" + "\n".join(rows[:300]) + "\n")
    (tmp_path / "x_test.csv").write_text("Id,a,c\n" + "\n".join(rows[300:]) + "\n")
    (tmp_path / "y_train.csv").write_text("Id,y\n" + "\n".join(f"{i},{1 if a[i] > 0 else -1}" for i in range(300)) + "\n")
    (tmp_path / "spec.json").write_text(json.dumps([{"id": "a", "description": "", "type": "continuous"},
                                                    {"id": "c", "description": "", "type": "auto"}]))
    result = run_files(spark, str(tmp_path), str(tmp_path / "spec.json"), steps=30, k=3, search=20)
    got = {r["Id"]: r["Prediction"] for r in result.predictions.collect()}
    assert sorted(got) == list(range(300, 400))
    assert np.mean([got[i] == (1 if a[i] > 0 else -1) for i in got]) > 0.9
    assert result.holdout["accuracy"] > 0.9


def test_exact_folds_leave_the_remainder_in_training(spark):
    df = spark.range(10)
    sizes = {r["fold"]: r["count"] for r in exact_folds(df, 3).groupBy("fold").count().collect()}
    assert sizes == {0: 3, 1: 3, 2: 3, 3: 1}
    sizes = {r["fold"]: r["count"] for r in exact_folds(df, 3, remainder="last").groupBy("fold").count().collect()}
    assert sizes == {0: 3, 1: 3, 2: 4}
    assert {r["fold"] for r in exact_folds(spark.range(2), 3).collect()} == {3}


def test_overlapping_batches_match_numpy(spark):
    rng = np.random.default_rng(4)
    n, size = 103, 20
    x = np.column_stack([np.ones(n), rng.standard_normal(n)])
    y = rng.standard_normal(n)
    starts = batch_starts(15, n, size)
    assert all(0 <= s <= n - size for s in starts) and any(s % size for s in starts)
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], float(y[i])) for i in range(n)], "rank long, x array<double>, y double")
    w, loss = fit_minibatch_windows(df.repartition(7), 2, starts, size, 0.1)
    want = np.zeros(2)
    for s in starts:
        a, b = x[s:s + size], y[s:s + size]
        want = want + 0.1 * a.T @ (b - a @ want) / size
    assert np.allclose(w, want) and np.isclose(loss, np.mean((y - x @ want) ** 2) / 2)


def test_gram_starts_no_job_to_plan_itself(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "array(1.0D, cast(id as double)) as x", "cast(id as double) as y").repartition(90)
    grams = gram_by_key(df, "x", "y", 2, "k")
    assert sorted(grams) == [0, 1, 2] and sum(g[0, 0] for g in grams.values()) == 1000
    assert np.isclose(sum(g[1, 2] for g in grams.values()), float(np.sum(np.arange(1000.0) ** 2)))


def test_models_start_from_given_weights_and_score(spark):
    from riskspark.plans import cv
    from riskspark.plans.models import LogisticRegressionGD, MSEGradientDescent, RegularizedLogisticRegressionGD
    rng = np.random.default_rng(2)
    v, y = rng.standard_normal(200), np.where(rng.random(200) < 0.4, 1, -1)
    df = spark.createDataFrame([(i, "train", int(y[i]), float(v[i])) for i in range(200)], "id long, split string, label int, v double")
    layout = FeatureLayout([FeatureColumn("v", "continuous", "v")]).with_intercept()
    data = cv.prepare(df, layout, 3)
    for model in (MSEGradientDescent(0, 0.1, initial_w=[0.5, 2.0]), LogisticRegressionGD(0, initial_w=[0.5, 2.0]),
                  RegularizedLogisticRegressionGD(0.3, 0, initial_w=[0.5, 2.0])):
        model.fit(data, layout)
        assert np.allclose(model.w, [0.5, 2.0])
        mean, std = model.scorer.mean[0], model.scorer.std[0]
        t = 0.5 + 2.0 * (v - mean) / std
        if model.config.loss == "mse":
            want = np.mean((y - t) ** 2) / 2
        else:
            want = np.mean(np.logaddexp(0, t) - (y == 1) * t)
        want += 0.3 * 4.25 if model.config.kind == "reg_logistic" else 0
        assert np.isclose(model.score(df), want)
        assert set(model.get_metrics(df)) == {"accuracy", "recall", "fpr", "precision", "f1"}
    assert np.isnan(model.score(df.limit(0)))
    with np.testing.assert_raises(ValueError):
        MSEGradientDescent(1, initial_w=[1.0]).fit(data, layout)
    with pytest.raises(RuntimeError):
        MSEGradientDescent().score(df)
