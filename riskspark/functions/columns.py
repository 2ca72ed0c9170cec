"""Column-expression kernels (JVM side, whole-stage-codegen friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(c: Column | str) -> Column:
    """Round to 6 places; ``+ 0.0`` folds a negative zero into 0.0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6) + F.lit(0.0)


def balanced_sum(terms: Sequence[Column]) -> Column:
    """Sum as a balanced tree: its depth is log2 of the number of terms, so wide
    sums do not overflow the stack of the expression walkers."""
    level = list(terms) or [F.lit(0.0)]
    while len(level) > 1:
        level = [a + b for a, b in zip(level[::2], level[1::2])] + (level[-1:] if len(level) % 2 else [])
    return level[0]


def dot(cols: Sequence[Column | str], weights: Sequence[float]) -> Column:
    """Linear predictor ``x . w`` over separate feature columns."""
    return balanced_sum([(F.col(c) if isinstance(c, str) else c) * F.lit(float(w)) for c, w in zip(cols, weights)])


def array_dot(features: Column | str, weights: Sequence[float]) -> Column:
    """Linear predictor over an ``ARRAY<DOUBLE>`` feature column."""
    arr = F.col(features) if isinstance(features, str) else features
    w = F.array(*[F.lit(float(v)) for v in weights])
    return F.aggregate(F.zip_with(arr, w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def sigmoid(t: Column) -> Column:
    """1 / (1 + e^-t)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-t))


def softplus(t: Column) -> Column:
    """log(1 + e^t) without overflow: max(t, 0) + ln(1 + e^-|t|)."""
    return F.greatest(t, F.lit(0.0)) + F.log(F.lit(1.0) + F.exp(-F.abs(t)))


def threshold_grid(n: int, lo: float = -1.0, hi: float = 1.0) -> list[float]:
    """n evenly spaced points in [lo, hi] including both ends, computed as
    ``i * step + lo`` in double (bit-identical to numpy.linspace(-1, 1, n))."""
    if n <= 0:
        return []
    if n == 1:
        return [float(lo)]
    step = (hi - lo) / (n - 1)
    return [i * step + lo for i in range(n)]


def bucket_of_score(score: Column, n: int, lo: float = -1.0, hi: float = 1.0) -> Column:
    """Number of grid thresholds strictly below ``score`` (0..n).

    A first estimate from arithmetic is corrected by comparing with the exact
    grid values, so the result equals a count over the grid without an O(n)
    scan per row. NULL / NaN scores land in bucket n (predicted positive, as
    ``score <= t`` is false for them).
    """
    if n == 1:
        return F.when(score > F.lit(float(lo)), 1).otherwise(0).cast("int")
    step = (hi - lo) / (n - 1)
    est = F.ceil((score - F.lit(lo)) / F.lit(step))
    est = F.least(F.greatest(est, F.lit(0)), F.lit(n)).cast("int")

    def t_at(i: Column) -> Column:
        return i.cast("double") * F.lit(step) + F.lit(lo)

    down = F.when((est > 0) & (t_at(est - 1) >= score), est - 1).otherwise(est)
    up = F.when((down < n) & (t_at(down) < score), down + 1).otherwise(down)
    return F.when(score.isNull() | F.isnan(score), F.lit(n)).otherwise(up).cast("int")
