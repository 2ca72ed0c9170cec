"""Grouped instance blocks: the same rows, the same gradients, less to stream."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import gd
from riskspark.operators.gd import Task, class_ratios, fit_gd, gradient_pass
from riskspark.operators.grouped import GroupedBlock, pack_grouped, read_grouped
from riskspark.operators.moments import iter_xyk

TASKS = [Task(loss, 0.5, 0.0, fold, balance) for fold in (-1, 0, 2) for loss, balance in
         (("mse", None), ("mse", "residual_sign"), ("logistic", None), ("logistic", "label"), ("logistic", "sigmoid_scale"))]


def _matrix(n=500, seed=3):
    rng = np.random.default_rng(seed)
    X = np.column_stack([np.ones(n), rng.normal(size=(n, 2)), rng.integers(0, 2, (n, 9))])
    X[:4, 1] = [0.0, 1.0, 40.0, -900.0]
    return X, np.where(rng.random(n) < 0.3, 1.0, -1.0), rng.integers(0, 4, n)


@pytest.fixture(scope="module")
def rows(spark):
    X, y, fold = _matrix()
    data = [([float(v) for v in x], float(t), int(f)) for x, t, f in zip(X, y, fold)]
    return spark.createDataFrame(data, "x array<double>, y double, fold int").repartition(3)


@pytest.mark.parametrize("change", ["none", "all different", "labels differ", "no rows shared", "one column"])
def test_block_holds_every_row(change):
    X, y, fold = _matrix(40)
    if change == "all different":
        X = X + np.arange(40)[:, None]
    if change == "labels differ":
        y = np.arange(40) / 7.0
    if change == "no rows shared":
        X = np.column_stack([X, np.eye(40)])
    if change == "one column":
        X = X[:, :1]
    batch = GroupedBlock.of(X, y, fold).batch()
    got = [np.column_stack([a, b, c]) for a, b, c in iter_xyk([batch], X.shape[1])]
    want = np.column_stack([X, y, fold])
    assert sorted(map(tuple, np.concatenate(got))) == sorted(map(tuple, want))


@pytest.mark.parametrize("block_rows", [None, 7])
def test_gradients_equal_those_of_rows(spark, rows, block_rows):
    blocks = pack_grouped(rows, "x", 12, block_rows=block_rows).persist()
    W = np.random.default_rng(1).normal(size=(12, len(TASKS)))
    ratios = class_ratios(rows, TASKS)
    assert np.array_equal(class_ratios(blocks, TASKS, d=12), ratios)
    plain = gradient_pass(rows, 12, TASKS, W, ratios)
    step = gradient_pass(blocks, 12, TASKS, W, ratios, with_loss=False)
    for i in (0, 1, 3):
        assert np.allclose(step[i], plain[i], rtol=1e-11, atol=1e-9)
    assert np.allclose(gradient_pass(blocks, 12, TASKS, W, ratios)[2], plain[2], rtol=1e-12)
    blocks.unpersist()


def test_steps_stream_grouped_blocks_without_losses(spark, rows, monkeypatch):
    """Before, every step streamed dense rows in one batch a task and computed a loss that only the last pass needs."""
    seen, plain = [], gd.gradient_pass

    def watched(df, *args, with_loss=True, **named):
        size = df.select(F.sum(sum(F.length(c) for c in df.columns if c.endswith("b")))).first()[0]
        seen.append((with_loss, size))
        return plain(df, *args, with_loss=with_loss, **named)

    monkeypatch.setattr(gd, "gradient_pass", watched)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    fit_gd(rows.withColumn("x", F.concat(F.slice("x", 1, 3), F.array_repeat(F.lit(0.0), 9))), 12, TASKS, 2)
    assert [s[0] for s in seen] == [False, False, True]
    assert seen[0][1] < 500 * 8 * 12 / 2
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def _line(n=4000):
    rng = np.random.default_rng(5)
    X = np.column_stack([np.ones(n), rng.integers(1, 21, n) / 50.0, rng.integers(0, 3, n) / 10.0, rng.normal(size=n)])
    return X, np.where(rng.random(n) < 0.3, 1.0, -1.0), rng.integers(0, 2, n)


@pytest.mark.parametrize("width, varying", [(3, 0), (4, 1)])
def test_columns_of_few_values_are_shared(width, varying):
    """Before, every column that was not 0/1 went to Python row by row in every step."""
    X, y, fold = _line()
    X = X[:, :width]
    batch = GroupedBlock.of(X, y, fold).batch()
    (block,) = read_grouped(batch, width)
    assert len(block.positions) == varying
    assert batch.nbytes < 8 * len(y) * (varying + 0.5)
    assert block.counts.sum() == len(y)
    got = np.concatenate([np.column_stack([a, b, c]) for a, b, c in block.dense()])
    assert sorted(map(tuple, got)) == sorted(map(tuple, np.column_stack([X, y, fold])))


def test_gradient_over_shared_columns_equals_that_of_rows(spark):
    X, y, fold = _line()
    data = [([float(v) for v in x], float(t), int(f)) for x, t, f in zip(X[:, :3], y, fold)]
    rows = spark.createDataFrame(data, "x array<double>, y double, fold int").repartition(2)
    blocks = pack_grouped(rows, "x", 3).persist()
    W = np.random.default_rng(1).normal(size=(3, len(TASKS)))
    ratios = class_ratios(rows, TASKS)
    plain = gradient_pass(rows, 3, TASKS, W, ratios)
    step = gradient_pass(blocks, 3, TASKS, W, ratios, with_loss=False)
    for i in (0, 1, 3):
        assert np.allclose(step[i], plain[i], rtol=1e-11, atol=1e-9)
    blocks.unpersist()


def test_few_values_are_not_shared_where_groups_would_outweigh_them():
    rng = np.random.default_rng(6)
    X = np.column_stack([np.ones(300), rng.integers(0, 200, (300, 2)) / 7.0])
    block = GroupedBlock.of(X, np.ones(300), np.zeros(300, np.int64))
    assert len(block.positions) and len(block.starts) < 300


def test_same_descents_share_their_gradients(spark, rows, monkeypatch):
    """Before, models that differ in their thresholds alone had every gradient computed again."""
    seen, plain = [], gd.gradient_pass

    def watched(df, d, tasks, *args, **named):
        seen.append(len(tasks))
        return plain(df, d, tasks, *args, **named)

    monkeypatch.setattr(gd, "gradient_pass", watched)
    twice = [*TASKS, *[Task(t.loss, t.gamma, t.lam, t.val_fold, t.balance) for t in TASKS], Task("mse", 0.4), Task("mse", 0.5, 0.1)]
    mask = np.ones((12, len(twice)))
    mask[3, 4] = 0.0
    W, loss = fit_gd(rows, 12, twice, 3, mask=mask)
    n = len(TASKS)
    assert seen == [n + 3] * 4
    W1, loss1 = fit_gd(rows, 12, twice[n:], 3)
    assert np.allclose(W[:, n:], W1, rtol=1e-10) and np.allclose(loss[n:], loss1, rtol=1e-10)
    same = [m for m in range(n) if m != 4]
    assert np.array_equal(W[:, same], W[:, [m + n for m in same]]) and np.array_equal(loss[same], loss[[m + n for m in same]])
    assert W[3, 4] == 0.0 and W[3, 4 + n] != 0.0
