"""Training kernels against direct NumPy, and partition independence."""

import numpy as np
import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from riskspark.operators import linear
from riskspark.operators.encode import assemble
from riskspark.operators.gd import Task, fit_gd
from riskspark.operators.moments import gram_by_key


def _data(spark, n=300, d=3, seed=0, parts=4):
    rng = np.random.default_rng(seed)
    X = np.column_stack([np.ones(n), rng.normal(size=(n, d - 1))])
    y = np.where(X @ rng.normal(size=d) + rng.normal(size=n) > 0.5, 1.0, -1.0)
    rows = [(int(i), float(y[i]), int(i % 5), *map(float, X[i])) for i in range(n)]
    cols = [f"c{j}" for j in range(d)]
    df = spark.createDataFrame(rows, "id long, y double, fold int, " + ", ".join(f"{c} double" for c in cols))
    return df.repartition(parts).select("id", "y", "fold", assemble(cols)), X, y


def _np_logistic(X, y, gamma, steps, lam=0.0):
    y01 = (y == 1).astype(float)
    w = np.zeros(X.shape[1])
    for _ in range(steps):
        s = 1 / (1 + np.exp(-(X @ w)))
        w = w - gamma * (X.T @ (s - y01) / len(y) + 2 * lam * w)
    return w


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_logistic_gd_matches_numpy(spark, parts):
    df, X, y = _data(spark, parts=parts)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    W, _ = fit_gd(df, 3, [Task("logistic", 0.7, 0.0, -1), Task("logistic", 0.3, 0.1, -1)], 7)
    assert np.allclose(W[:, 0], _np_logistic(X, y, 0.7, 7), atol=1e-12)
    assert np.allclose(W[:, 1], _np_logistic(X, y, 0.3, 7, 0.1), atol=1e-12)


def test_per_fold_training_excludes_validation_rows(spark):
    df, X, y = _data(spark)
    fold = np.arange(len(y)) % 5
    W, _ = fit_gd(df, 3, [Task("logistic", 0.5, 0.0, 2)], 4)
    keep = fold != 2
    assert np.allclose(W[:, 0], _np_logistic(X[keep], y[keep], 0.5, 4), atol=1e-12)


def test_gram_gd_equals_stepwise_gd(spark):
    df, X, y = _data(spark)
    Z = gram_by_key(df, "x", "y", 3)[0]
    w = linear.gd_from_gram(Z[:3, :3], Z[:3, 3], Z[0, 0], 0.1, 25)
    v = np.zeros(3)
    for _ in range(25):
        v = v - 0.1 * (-(X.T @ (y - X @ v)) / len(y))
    assert np.allclose(w, v, atol=1e-12)
    ls = linear.least_squares(Z[:3, :3], Z[:3, 3])
    assert np.allclose(X.T @ (y - X @ ls), 0, atol=1e-9)


def test_mse_gd_via_passes_equals_gram(spark):
    df, X, y = _data(spark)
    W, loss = fit_gd(df, 3, [Task("mse", 0.1, 0.0, -1)], 10)
    Z = gram_by_key(df, "x", "y", 3)[0]
    w = linear.gd_from_gram(Z[:3, :3], Z[:3, 3], Z[0, 0], 0.1, 10)
    assert np.allclose(W[:, 0], w, atol=1e-12)
    assert abs(loss[0] - linear.mse_from_gram(Z[:3, :3], Z[:3, 3], Z[3, 3], Z[0, 0], w)) < 1e-12


def test_sums_have_one_order(spark, monkeypatch):
    """The driver's sum of few partitions and the cluster's sum of many agree to the last bit."""
    from riskspark.operators import gd
    df, X, y = _data(spark, parts=6)
    tasks = [Task("logistic", 0.7, 0.0, i % 5) for i in range(400)]
    W1, _ = fit_gd(df, 3, tasks, 2)
    plain = gd.reduce_partials
    monkeypatch.setattr(gd, "reduce_partials", lambda partials, n_parts: plain(partials, None))
    W2, _ = fit_gd(df, 3, tasks, 2)
    assert np.array_equal(W1, W2)


def test_more_partitions_than_groups(spark):
    df, X, y = _data(spark, n=700, parts=150)
    W, _ = fit_gd(df, 3, [Task("logistic", 0.7, 0.0, -1)], 3)
    assert np.allclose(W[:, 0], _np_logistic(X, y, 0.7, 3), atol=1e-12)


def test_a_stopped_run_goes_on(spark, tmp_path, monkeypatch):
    from riskspark.operators import gd
    from riskspark.sources.steps import StepTable
    df, X, y = _data(spark)
    tasks = [Task("logistic", 0.7, 0.0, i) for i in range(-1, 3)]
    straight, loss = fit_gd(df, 3, tasks, 11)
    passes, plain = [], gd.gradient_pass

    def counted(*args, **named):
        if len(passes) == 7:
            raise RuntimeError("lost")
        passes.append(1)
        return plain(*args, **named)

    state = StepTable(spark, str(tmp_path / "steps"), every=3)
    assert state.last("none", 9) is None
    monkeypatch.setattr(gd, "gradient_pass", counted)
    with pytest.raises(RuntimeError):
        fit_gd(df, 3, tasks, 11, state=state)
    passes.clear()
    monkeypatch.setattr(gd, "gradient_pass", lambda *a, **k: (passes.append(1), plain(*a, **k))[1])
    W, again = fit_gd(df, 3, tasks, 11, state=state)
    assert len(passes) == 11 - 6 + 1 and np.array_equal(W, straight) and np.array_equal(again, loss)
    passes.clear()
    fit_gd(df, 3, [Task("logistic", 0.5, 0.0, i) for i in range(-1, 3)], 2, state=state)  # another run
    assert len(passes) == 3


def test_cross_validation_goes_on_from_its_folder(spark, tmp_path, monkeypatch):
    from riskspark.operators import gd
    from riskspark.operators.clean import FeatureColumn, FeatureLayout
    from riskspark.plans import cv
    rng = np.random.default_rng(3)
    v, y = rng.standard_normal(300), np.where(rng.random(300) < 0.4, 1, -1)
    df = spark.createDataFrame([(i, "train", int(y[i]), float(v[i])) for i in range(300)], "id long, split string, label int, v double")
    layout = FeatureLayout([FeatureColumn("v", "continuous", "v")]).with_intercept()
    data, configs = cv.prepare(df, layout, 3), [cv.ModelConfig("logistic", 8, 0.7), cv.ModelConfig("mse_gd", 8, 0.1)]
    straight = list(cv.cross_validate(data, layout, configs, 3, 20).rows())
    plain = gd.gradient_pass
    calls = []

    def lost(*args, **named):
        calls.append(1)
        if len(calls) == 6:
            raise RuntimeError("lost")
        return plain(*args, **named)

    monkeypatch.setattr(gd, "gradient_pass", lost)
    with pytest.raises(RuntimeError):
        cv.cross_validate(data, layout, configs, 3, 20, resume=str(tmp_path), save_every=2)
    monkeypatch.setattr(gd, "gradient_pass", plain)
    resumed = list(cv.cross_validate(data.where("false"), layout, configs, 3, 20, resume=str(tmp_path), save_every=2).rows())
    assert resumed == straight


def test_cross_validation_goes_on_whatever_the_order_of_the_moments_sums(spark, tmp_path, monkeypatch):
    from riskspark.operators import gd
    from riskspark.operators.clean import FeatureColumn, FeatureLayout
    from riskspark.plans import cv
    rows = [(i, "train", 1 if i % 3 else -1, float(i * i % 37)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, split string, label int, v double")
    layout = FeatureLayout([FeatureColumn("v", "continuous", "v")]).with_intercept()
    data, passes, sums = cv.prepare(df, layout, 3), [], []
    plain, moments = gd.gradient_pass, cv.fold_moments

    def other_order(*args):
        sums.append(1)
        found = moments(*args)
        return {f: (n, np.nextafter(mu, len(sums) * 100.0), m2) for f, (n, mu, m2) in found.items()} if len(sums) > 1 else found

    monkeypatch.setattr(cv, "fold_moments", other_order)
    monkeypatch.setattr(gd, "gradient_pass", lambda *a, **k: (passes.append(1), plain(*a, **k))[1])
    for steps in (4, 10):
        passes.clear()
        res = cv.cross_validate(data, layout, [cv.ModelConfig("logistic", steps, 0.7)], 3, 20, resume=str(tmp_path), save_every=2)
    assert len(passes) == 10 - 4 + 1
    monkeypatch.setattr(cv, "fold_moments", moments)
    straight = cv.cross_validate(data, layout, [cv.ModelConfig("logistic", 10, 0.7)], 3, 20)
    assert [r["f1"] for r in res.rows()] == [r["f1"] for r in straight.rows()]
    np.testing.assert_allclose([r.weights for r in res.folds], [r.weights for r in straight.folds], rtol=1e-9)
