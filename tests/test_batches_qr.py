"""Batch store, tall-skinny QR and ranks on keys."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import linear, split
from riskspark.operators.batches import fit_batches, loss_of, write_batches
from riskspark.operators.encode import assemble
from riskspark.operators.gd import Task, batch_schedule, exact_batches, fit_minibatch
from riskspark.operators.moments import gram_by_key


def _rows(spark, n=1037, seed=0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([np.ones(n), rng.standard_normal((n, 2))])
    y = np.where(x @ [0.2, 1.0, -0.7] + rng.standard_normal(n) > 0, 1.0, -1.0)
    rows = [(i, [float(v) for v in x[i]], float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, x array<double>, y double").repartition(6), x, y


def test_store_trains_like_numpy_and_like_the_gram(spark, tmp_path):
    df, x, y = _rows(spark)
    batched, n_batches = exact_batches(df, 100)
    batch = np.zeros(len(y), int)
    for r in batched.select("id", "batch").collect():
        batch[r.id] = r.batch
    store = write_batches(batched, 3, n_batches, str(tmp_path / "store"), block_bytes=1000)
    schedule = batch_schedule(17, n_batches)
    got = fit_batches(store, Task("mse", 0.1), schedule)
    assert np.allclose(got, fit_minibatch(batched, 3, schedule, 0.1)[0], atol=1e-12)
    w = np.zeros(3)
    for b in schedule:
        a, t = x[batch == b], (y[batch == b] == 1).astype(float)
        w = w - 0.5 * (a.T @ (1 / (1 + np.exp(-a @ w)) - t) / len(t) + 0.02 * w)
    task = Task("logistic", 0.5, 0.01)
    assert np.allclose(fit_batches(store, task, schedule), w, atol=1e-12)
    assert np.isclose(loss_of(store, task, w), np.mean(np.logaddexp(0, x @ w) - (y == 1) * (x @ w)))


def test_a_step_reads_its_batch_alone(spark, tmp_path):
    """Bytes read grow with the steps: the folder of one batch, whatever the table holds."""
    df, _, _ = _rows(spark, 3000)
    batched, n_batches = exact_batches(df, 100)
    store = write_batches(batched, 3, n_batches, str(tmp_path / "store"))
    step = store.batch(7)
    plan = step._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(folder" in plan and "(folder#" in plan and "= 7)" in plan
    metrics = step._jdf.queryExecution().executedPlan()
    assert step.selectExpr("sum(n)").first()[0] == 100
    import os
    sizes = {name: sum(os.path.getsize(tmp_path / "store" / name / f) for f in os.listdir(tmp_path / "store" / name)) for name in os.listdir(tmp_path / "store")
             if name.startswith("folder=")}
    assert len(sizes) == 30 and max(sizes.values()) < 2 * sum(sizes.values()) / 30 and metrics is not None


def test_many_batches_share_folders(spark, tmp_path, monkeypatch):
    from riskspark.operators import batches
    monkeypatch.setattr(batches, "MAX_DIRS", 4)
    df, x, y = _rows(spark)
    batched, n_batches = exact_batches(df, 50)
    store = write_batches(batched, 3, n_batches, str(tmp_path / "store"))
    assert store.per_folder == 5 and sorted(r[0] for r in store.blocks.select("folder").distinct().collect()) == [-1, 0, 1, 2, 3]
    sizes = [store.batch(b).agg(F.sum("n")).first()[0] for b in range(n_batches)]
    assert sizes == [50] * n_batches and store.everything().agg(F.sum("n")).first()[0] == len(y)
    got = fit_batches(store, Task("mse", 0.1), range(n_batches))
    assert np.allclose(got, fit_minibatch(batched, 3, list(range(n_batches)), 0.1)[0], atol=1e-12)


def _exact(x, y):
    """Least squares in rational arithmetic."""
    x = [[Fraction(float(v)) for v in row] for row in x]
    y = [Fraction(float(v)) for v in y]
    d = len(x[0])
    rows = [[sum(r[i] * r[j] for r in x) for j in range(d)] + [sum(r[i] * t for r, t in zip(x, y))] for i in range(d)]
    for i in range(d):
        pivot = rows[i][i]
        rows[i] = [v / pivot for v in rows[i]]
        for k in range(d):
            if k != i:
                rows[k] = [a - rows[k][i] * b for a, b in zip(rows[k], rows[i])]
    return np.array([float(r[d]) for r in rows])


def test_qr_keeps_digits_that_normal_equations_lose(spark):
    """Degree 7 of a column far from zero."""
    rng = np.random.default_rng(1)
    v = np.round(rng.uniform(2, 3, 240), 3)
    x = np.column_stack([v ** j for j in range(8)])
    y = np.round(np.sin(3 * v) + 0.1 * rng.standard_normal(240), 4)
    want = _exact(x, y)
    df = spark.createDataFrame([([float(a) for a in r], float(t), i % 3) for i, (r, t) in enumerate(zip(x, y))],
                               "x array<double>, y double, fold int").repartition(70)
    factors = linear.fold_factors(df, 8)
    assert sorted(factors) == [0, 1, 2]
    w, rss = linear.least_squares_qr(linear.combine_factors(factors, None))
    error = np.max(np.abs(w - want) / np.abs(want))
    Z = sum(gram_by_key(df, "x", "y", 8, "fold").values())
    normal = np.max(np.abs(linear.least_squares(Z[:8, :8], Z[:8, 8]) - want) / np.abs(want))
    assert error < 1e-4 and normal > 100 * error
    assert np.isclose(rss, np.sum((y - x @ want) ** 2), rtol=1e-8)
    part = np.arange(240) % 3 != 1
    assert np.allclose(linear.least_squares_qr(linear.combine_factors(factors, 1))[0], _exact(x[part], y[part]), rtol=1e-3)


def test_qr_models_equal_the_gram_models(spark):
    from riskspark.operators.clean import FeatureColumn, FeatureLayout
    from riskspark.plans import cv
    rng = np.random.default_rng(5)
    v, u, y = rng.standard_normal(400), rng.uniform(5, 9, 400), np.where(rng.random(400) < 0.4, 1, -1)
    df = spark.createDataFrame([(i, "train", int(y[i]), float(v[i]), float(u[i])) for i in range(400)], "id long, split string, label int, v double, u double")
    layout = FeatureLayout([FeatureColumn(c, "continuous", c) for c in ("v", "u")]).with_intercept()
    data = cv.prepare(df, layout, 3)
    kinds = [cv.ModelConfig("least_squares"), cv.ModelConfig("least_squares_qr"), cv.ModelConfig("ridge", lam=0.1), cv.ModelConfig("ridge_qr", lam=0.1),
             cv.ModelConfig("least_squares", positions=(0, 2)), cv.ModelConfig("least_squares_qr", positions=(0, 2))]
    res = cv.cross_validate(data, layout, kinds, 3, 20)
    by = {(r.config, r.fold): r for r in res.folds}
    for a, b in ((0, 1), (2, 3), (4, 5)):
        for f in range(3):
            assert np.allclose(by[a, f].weights, by[b, f].weights, atol=1e-9) and np.isclose(by[a, f].train_loss, by[b, f].train_loss)
            assert np.isclose(by[a, f].val_loss, by[b, f].val_loss)


def test_dependent_columns_are_an_error(spark):
    df = spark.createDataFrame([([1.0, float(i), 2.0 * i], float(i % 3), 0) for i in range(30)], "x array<double>, y double, fold int")
    with pytest.raises(np.linalg.LinAlgError):
        linear.least_squares_qr(linear.fold_factors(df, 3)[0])


def test_ranks_move_keys_only(spark):
    df = spark.range(5000).selectExpr("id", "id * 2 as a", "uuid() as wide").repartition(9)
    ranks = split.key_ranks(df, "s", "id")
    plan = ranks._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "rangepartitioning" not in physical and "wide" not in physical
    got = [r["rank"] for r in ranks.collect()]
    assert sorted(got) == list(range(5000))
    order = [r["id"] for r in ranks.orderBy("rank").collect()]
    from riskspark.functions.hashing import hash32_value
    assert order == sorted(range(5000), key=lambda i: (hash32_value("s", i), i))
    folds = split.exact_folds(df, 4, 1)
    assert "rangepartitioning" not in folds._jdf.queryExecution().toString()
    null = spark.createDataFrame([(None, 1), (1, 2)], "id long, a int")
    assert sorted(r["rank"] for r in split.exact_rank(null, "s").collect()) == [0, 1]
