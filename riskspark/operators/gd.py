"""Gradient descent for many models per data pass.

Each model ("task") is defined by its loss, step size, L2 weight, validation
fold and an affine scaler x~ = a * x + c (per-fold standardisation). Scaling is
folded into the weights (t = (A^T w) . x), so the persisted input is one
copy of the raw features and every step is ONE job for all folds and grid
points: NumPy over Arrow batches computes X^T R per partition, partial sums
are reduced on the cluster (or collected when provably small), and the
driver applies the update to a D x M weight matrix.

Lineage does not grow: every step reads the same persisted frame with new
literal weights shipped in the closure.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.grouped import is_grouped, label_counts, pack_grouped, read_grouped
from riskspark.operators.moments import (PARTIAL_SCHEMA, batches_for, chunked, is_blocks, iter_xyk, partial_batch, reduce_partials,
                                         unchunk)
from riskspark.sources.steps import StepTable, run_name

LOSSES = ("mse", "logistic")
BALANCES = (None, "residual_sign", "label", "sigmoid_scale")


@dataclass
class Task:
    loss: str = "logistic"
    gamma: float = 0.7
    lam: float = 0.0
    val_fold: int = -1                 # rows with fold == val_fold are not trained on
    balance: str | None = None
    a: np.ndarray | None = None        # x~_j = a_j * x_j + c_j  (x_0 is the intercept)
    c: np.ndarray | None = None
    tag: dict = field(default_factory=dict)


def negative_positive_ratio(neg: float, pos: float) -> float:
    """#(-1) / #(+1); 1.0 without negatives; no positives is an error."""
    if neg == 0:
        return 1.0
    if pos == 0:
        raise ValueError("class ratio undefined: no positive labels in the training part")
    return neg / pos


def class_ratios(df: DataFrame, tasks: Sequence[Task], fold_col: str = "fold", y_col: str = "y", d: int | None = None) -> np.ndarray:
    """Per task, the class ratio of its training part (one grouped count; none where no task is balanced).
    ``df`` may be grouped blocks of ``d`` features."""
    if not any(t.balance for t in tasks):
        return np.ones(len(tasks))
    found = label_counts(df, d) if is_grouped(df) else df.groupBy(fold_col, y_col).count()
    counts = {(r[0], r[1]): r[2] for r in found.collect()}
    out = []
    for t in tasks:
        neg = sum(c for (f, y), c in counts.items() if f != t.val_fold and y == -1)
        pos = sum(c for (f, y), c in counts.items() if f != t.val_fold and y == 1)
        out.append(negative_positive_ratio(neg, pos) if t.balance else 1.0)
    return np.array(out)


def _affine(tasks: Sequence[Task], d: int):
    A = np.ones((d, len(tasks)))
    C = np.zeros((d, len(tasks)))
    for m, t in enumerate(tasks):
        if t.a is not None:
            A[:, m] = t.a
        if t.c is not None:
            C[:, m] = t.c
    return A, C


def effective_weights(W: np.ndarray, A: np.ndarray, C: np.ndarray):
    """Raw-coordinate weights V and bias b with x~ . w == x . V + b."""
    return W * A, np.sum(W * C, axis=0)


def _row_terms(T, y, member, loss_codes, bal_codes, ratios):
    """Per-row residual R (d loss / d t) and loss for every model column.

    loss 0 = mse (balance 1: residual-sign rule), loss 1 = logistic on 0/1
    labels (balance 2: weight r on the minority label; balance 3: the coded
    rule on +/-1 labels that scales the sigmoid itself). Columns sharing a
    (loss, balance) pair are computed together, each group only its branch."""
    n, M = T.shape
    R = np.empty((n, M))
    L = np.empty((n, M))
    yc = y[:, None]
    y01 = (yc == 1).astype(float)
    for lc, bc in {(int(a), int(b)) for a, b in zip(loss_codes, bal_codes)}:
        cols = np.flatnonzero((loss_codes == lc) & (bal_codes == bc))
        t = T[:, cols]
        r = ratios[cols][None, :]
        if lc == 0:
            e = yc - t
            if bc == 1:
                up = r > 1
                e = np.where(up & (e >= 0), e * r, e)
                e = np.where(~up & (e <= 0), e * r, e)
            R[:, cols] = -e
            L[:, cols] = 0.5 * e * e
            continue
        sp = np.maximum(t, 0.0) + np.log1p(np.exp(-np.abs(t)))  # log(1 + e^t); logaddexp takes several times as long
        with np.errstate(over="ignore"):
            s = 1.0 / (1.0 + np.exp(-t))
        if bc == 3:
            w = np.where(np.where(r > 1, yc == 1, yc == -1), r, 1.0)
            R[:, cols] = s * w - yc
            L[:, cols] = (-yc * t + sp) * w
        elif bc == 2:
            w = np.where(np.where(r > 1, y01 == 1, y01 == 0), r, 1.0)
            R[:, cols] = w * (s - y01)
            L[:, cols] = w * (-y01 * t + sp)
        else:
            R[:, cols] = s - y01
            L[:, cols] = -y01 * t + sp
    R *= member
    L *= member
    return R, L


def _residuals(T, y, loss_codes, bal_codes, ratios):
    """R of ``_row_terms`` alone, for tasks x rows; T may be overwritten. Gradient steps need no loss."""
    R = T
    y01 = (y == 1).astype(float)
    kinds = {(int(a), int(b)) for a, b in zip(loss_codes, bal_codes)}
    for lc, bc in kinds:
        of_kind = slice(None) if len(kinds) == 1 else np.flatnonzero((loss_codes == lc) & (bal_codes == bc))
        t = T[of_kind]
        r = ratios[of_kind][:, None]
        if lc == 0:
            np.subtract(t, y, out=t)                      # -e
            if bc == 1:
                np.minimum(t, t * r, out=t)           # r > 1 on t <= 0, r < 1 on t >= 0: the smaller one either way
        else:
            with np.errstate(over="ignore"):
                np.exp(np.negative(t, out=t), out=t)
            t += 1.0
            np.reciprocal(t, out=t)
            if bc == 3:
                np.multiply(t, r, out=t, where=y == np.where(r > 1, 1.0, -1.0))
                t -= y
            else:
                t -= y01
                if bc == 2:
                    np.multiply(t, r, out=t, where=y01 == (r > 1))
        if len(kinds) > 1:
            R[of_kind] = t
    return R


def _codes(tasks):
    loss_codes = np.array([LOSSES.index(t.loss) for t in tasks])
    bal_codes = np.array([BALANCES.index(t.balance) for t in tasks])
    return loss_codes, bal_codes


def gradient_pass(df: DataFrame, d: int, tasks: Sequence[Task], W: np.ndarray, ratios: np.ndarray,
                  x_col: str = "x", y_col: str = "y", fold_col: str = "fold", n_parts: int | None = None, with_loss: bool = True):
    """One job: per task, sum over its training rows of (X^T R, sum R, loss, count).
    ``n_parts`` (partition count of ``df``, where it is known) saves a shuffle of few partial vectors.
    ``with_loss`` false: the sum of the loss, which a step does not use, is left 0."""
    A, C = _affine(tasks, d)
    V, b = effective_weights(W, A, C)
    val = np.array([t.val_fold for t in tasks])
    loss_codes, bal_codes = _codes(tasks)
    M = len(tasks)
    grouped = is_grouped(df)

    def residuals(T, y, of):
        return _residuals(T, y, loss_codes[of], bal_codes[of], ratios[of])

    def kernel(batches):
        G = np.zeros((d, M))
        S = np.zeros(M)
        LS = np.zeros(M)
        N = np.zeros(M)
        if grouped and not with_loss:
            for batch in batches:
                for block in read_grouped(batch, d):
                    block.add_gradient(V, b, val, residuals, G, S, N)
        else:
            for X, y, fold in iter_xyk(batches, d, x_col, y_col, fold_col):
                member = (fold[:, None] != val[None, :]).astype(float)
                T = X @ V + b
                if with_loss:
                    R, L = _row_terms(T, y, member, loss_codes, bal_codes, ratios)
                    LS += L.sum(axis=0)
                else:
                    R = residuals(np.ascontiguousarray(T.T), y, slice(None)).T * member
                G += X.T @ R
                S += R.sum(axis=0)
                N += member.sum(axis=0)
        yield partial_batch(chunked(np.concatenate([G.ravel(), S, LS, N])))

    from riskspark.session import ship_package
    ship_package(df.sparkSession)
    src = df if is_blocks(df) else df.select(x_col, y_col, fold_col)
    with batches_for(src):
        vec = unchunk(reduce_partials(src.mapInArrow(kernel, PARTIAL_SCHEMA), n_parts))
    G = vec[:d * M].reshape(d, M)
    S, LS, N = vec[d * M:d * M + M], vec[d * M + M:d * M + 2 * M], vec[d * M + 2 * M:]
    return G, S, LS, N


def distinct_tasks(tasks: Sequence[Task], W: np.ndarray, ratios: np.ndarray, mask: np.ndarray | None) -> tuple[list[int], np.ndarray]:
    """(first task of every descent, descent of every task): tasks that differ in their tags alone share one."""
    first: dict[tuple, int] = {}
    of = []
    for m, t in enumerate(tasks):
        arrays = [None if v is None else np.asarray(v, float).tobytes() for v in (t.a, t.c, W[:, m], None if mask is None else mask[:, m])]
        of.append(first.setdefault((t.loss, t.gamma, t.lam, t.val_fold, t.balance, float(ratios[m]), *arrays), m))
    own = sorted(first.values())
    return own, np.searchsorted(own, of)


def fit_gd(df: DataFrame, d: int, tasks: Sequence[Task], steps: int, x_col: str = "x", y_col: str = "y",
           fold_col: str = "fold", ratios: np.ndarray | None = None, initial: np.ndarray | None = None,
           mask: np.ndarray | None = None, state: StepTable | None = None):
    """Run ``steps`` full-batch GD steps for all tasks at once.

    ``state``: a table of weights by step. The run goes on from the last step that the table has of a
    run with the same tasks and start, and stores its own weights every ``state.every``
    steps and at the end, so that no more than that is done twice after a lost driver.

    ``mask`` (d x M, 0/1) restricts a task to a subset of the features (its
    other weights stay 0), so nested feature sets share the same passes.
    Tasks with the same descent (models that differ in their thresholds alone) share its gradients.
    Returns (W [d x M] in scaled coordinates, final training loss [M] without
    the L2 term). Rows are read once, into grouped blocks that are persisted here; blocks are persisted by the caller."""
    M = len(tasks)
    packed = None
    if not is_blocks(df):
        from pyspark import StorageLevel
        packed = pack_grouped(df, x_col, d, y_col, fold_col).persist(StorageLevel.MEMORY_AND_DISK)
        packed.count()
        df = packed
    if ratios is None:
        ratios = class_ratios(df, tasks, fold_col, y_col, d)
    n_parts = df.rdd.getNumPartitions()
    A, C = _affine(tasks, d)
    W = np.zeros((d, M)) if initial is None else np.array(initial, dtype=float)
    first, run = 0, ""
    if state is not None:
        run = run_name(d, tasks, W, ratios, mask)
        first, W = state.last(run, steps) or (0, W)
    gam = np.array([t.gamma for t in tasks])
    lam = np.array([t.lam for t in tasks])
    own, of = distinct_tasks(tasks, W, ratios, mask)
    distinct = [tasks[m] for m in own]
    for step in range(first, steps):
        G, S, _, N = gradient_pass(df, d, distinct, W[:, own], ratios[own], x_col, y_col, fold_col, n_parts, with_loss=False)
        G, S, N = G[:, of], S[of], N[of]
        with np.errstate(invalid="ignore", divide="ignore"):
            grad = (A * G + C * S[None, :]) / N[None, :]
        grad = grad + 2.0 * lam[None, :] * W
        if mask is not None:
            grad = grad * mask
        W = W - gam[None, :] * grad
        if state is not None and ((step + 1) % state.every == 0 or step + 1 == steps):
            state.save(run, step + 1, W)
    _, _, LS, N = gradient_pass(df, d, distinct, W[:, own], ratios[own], x_col, y_col, fold_col, n_parts)
    LS, N = LS[of], N[of]
    if packed is not None:
        packed.unpersist()
    with np.errstate(invalid="ignore", divide="ignore"):
        loss = LS / N
    return W, loss


def batch_column(size: int, n_rows: int, seed="batch", key: str = "id"):
    """D13 re-aimed: contiguous batches of a permutation become hash buckets;
    ``n_rows // size`` batches (at least one), each about ``size`` rows."""
    from riskspark.functions.hashing import hash32
    n_batches = max(1, n_rows // max(1, size))
    return F.pmod(hash32(seed, key), F.lit(n_batches)).cast("int"), n_batches


def exact_batches(df: DataFrame, size: int, seed="batch", key: str = "id"):
    """D13 exact: contiguous batches of the seeded permutation, ``batch = rank div
    size`` for the first ``max_batches * size`` rows; the remainder gets -1 and is
    never used (the reference's no-shuffle iterator). Returns (frame, max_batches)."""
    from riskspark.operators.split import exact_rank
    ranked = exact_rank(df, seed, key)
    n_rows = df.count()
    size = max(1, min(size, n_rows))
    max_batches = max(1, n_rows // size)
    batch = F.when(F.col("rank") < max_batches * size, (F.col("rank") / size).cast("bigint")).otherwise(F.lit(-1))
    return ranked.withColumn("batch", batch.cast("int")).drop("rank"), max_batches


def fit_minibatch(df: DataFrame, d: int, schedule: Sequence[int], gamma: float, initial: np.ndarray | None = None,
                  x_col: str = "x", y_col: str = "y", batch_col: str = "batch") -> tuple[np.ndarray, float]:
    """Mini-batch MSE gradient descent, one step per entry of ``schedule``; returns (weights, loss over all rows).

    One pass sums a Gram matrix for every scheduled batch and one for all other rows
    together, so what reaches the driver is bounded by the number of steps, not by the
    number of batches. A scheduled batch without rows is a step without effect."""
    from riskspark.operators import linear
    from riskspark.operators.moments import gram_by_key

    used = sorted(set(schedule))
    # -2 holds every row outside the schedule (-1 may be a remainder group of its own)
    group = F.when(F.col(batch_col).isin(used), F.col(batch_col)).otherwise(F.lit(-2)).cast("int")
    grams = gram_by_key(df.withColumn(batch_col, group), x_col, y_col, d, batch_col)
    w = np.zeros(d) if initial is None else np.array(initial, float)
    for b in schedule:
        if b in grams:
            Z = grams[b]
            w = linear.gd_from_gram(Z[:d, :d], Z[:d, d], Z[0, 0], gamma, 1, w)
    tot = sum(grams.values())
    return w, linear.mse_from_gram(tot[:d, :d], tot[:d, d], tot[d, d], tot[0, 0], w)


def batch_starts(num_steps: int, n_rows: int, size: int, seed="batch") -> list[int]:
    """D13 with shuffle: the first rank of each step's batch. A batch is drawn among the int(N / size) whole
    ones and moved on by 0..remainder rows, so that the remainder is reached too; batches may overlap.

    Drawn from md5 keys of the step number, like every other random choice here."""
    from riskspark.functions.hashing import hash32_value

    size = max(1, min(size, n_rows))
    whole = max(1, n_rows // size)
    extra = max(0, n_rows - whole * size)
    return [hash32_value(f"{seed}-start", t) % whole * size + hash32_value(f"{seed}-offset", t) % (extra + 1)
            for t in range(num_steps)]


def fit_minibatch_windows(df: DataFrame, d: int, starts: Sequence[int], size: int, gamma: float,
                          initial: np.ndarray | None = None, x_col: str = "x", y_col: str = "y",
                          rank_col: str = "rank") -> tuple[np.ndarray, float]:
    """E3 over batches that may overlap: step t uses the rows of rank starts[t] .. starts[t] + size - 1.

    The batch ends cut the ranks into at most 2 * steps + 1 pieces. One pass sums a Gram
    matrix per piece; a batch's Gram is the sum of its pieces, so no row is read twice and
    what reaches the driver does not depend on the row count."""
    from riskspark.operators import linear
    from riskspark.operators.moments import gram_by_key

    cuts = sorted({c for s in starts for c in (s, s + size)})
    piece = F.size(F.filter(F.array(*[F.lit(c).cast("bigint") for c in cuts]), lambda c: c <= F.col(rank_col)))
    grams = gram_by_key(df.select(x_col, y_col, piece.alias("piece")), x_col, y_col, d, "piece")
    w = np.zeros(d) if initial is None else np.array(initial, float)
    for s in starts:
        own = [g for p, g in grams.items() if p and s <= cuts[p - 1] < s + size]
        if own:
            Z = sum(own)
            w = linear.gd_from_gram(Z[:d, :d], Z[:d, d], Z[0, 0], gamma, 1, w)
    tot = sum(grams.values())
    return w, linear.mse_from_gram(tot[:d, :d], tot[:d, d], tot[d, d], tot[0, 0], w)


def batch_schedule(num_steps: int, n_batches: int, shuffle: bool = False, seed: int = 0) -> list[int]:
    """Batch index used at each step: circular without shuffle, seeded choice with it."""
    if not shuffle:
        return [i % n_batches for i in range(num_steps)]
    rng = np.random.default_rng(seed)
    return [int(v) for v in rng.integers(0, n_batches, size=num_steps)]
