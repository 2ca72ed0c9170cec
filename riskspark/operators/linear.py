"""E1, E4, E5 and D3 from Gram matrices: one data pass, then D x D algebra.

``fold_grams`` returns sum(z z^T), z = [x', y], per fold, where x' is x with a
global shift/scale on the continuous positions (numerical safety only). Every
model's training Gram is the sum over its training folds mapped by the affine
scaler, so all folds, step sizes, ridge weights -- and, for polynomial
degrees, nested sub-matrices -- share the same single pass.

Normal equations square the condition number. ``fold_factors`` is the way around it: a
tall-skinny QR. Every task folds its rows of [x', y] into one triangular factor R, factors
are merged two by two by QR again, and the solution comes from R alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.moments import FAN, PARTIAL_SCHEMA, gram_by_key, is_blocks, iter_xyk, partial_batch


def fold_grams(df: DataFrame, d: int, x_col: str = "x", y_col: str = "y", fold_col: str | None = "fold",
               shift: np.ndarray | None = None, scale: np.ndarray | None = None) -> dict:
    return gram_by_key(df, x_col, y_col, d, fold_col, shift, scale)


def affine_matrix(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A with x~ = A x for x whose position 0 is the intercept (x_0 = 1)."""
    d = len(a)
    A = np.diag(np.asarray(a, dtype=float))
    A[:, 0] += np.asarray(c, dtype=float)
    A[0, 0] = a[0] + c[0]
    return A


def map_gram(Z: np.ndarray, A: np.ndarray):
    """Scaled statistics (G~, b~, y'y, n) from an augmented Gram in x' coords."""
    d = A.shape[0]
    G = Z[:d, :d]
    b = Z[:d, d]
    yy = Z[d, d]
    n = Z[0, 0]                               # intercept column: sum of 1 * 1
    return A @ G @ A.T, A @ b, yy, n


def combine(grams: dict, exclude: int | None) -> np.ndarray:
    return sum(g for k, g in grams.items() if k != exclude)


def mse_from_gram(G: np.ndarray, b: np.ndarray, yy: float, n: float, w: np.ndarray) -> float:
    """D3 = 1/(2n) * ||y - Xw||^2 = (y'y - 2 w'b + w'Gw) / 2n."""
    return float((yy - 2.0 * w @ b + w @ G @ w) / (2.0 * n))


def gd_from_gram(G: np.ndarray, b: np.ndarray, n: float, gamma: float, steps: int,
                 initial: np.ndarray | None = None) -> np.ndarray:
    """Exactly ``steps`` steps of w <- w + gamma/n (b - G w); no stopping rule."""
    w = np.zeros(len(b)) if initial is None else np.array(initial, dtype=float)
    for _ in range(steps):
        w = w + gamma * (b - G @ w) / n
    return w


def least_squares(G: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solve X'X w = X'y; a singular system raises numpy.linalg.LinAlgError."""
    return np.linalg.solve(G, b)


def ridge(G: np.ndarray, b: np.ndarray, n: float, lam: float) -> np.ndarray:
    """E5: solve (X'X + 2 lambda n I) w = X'y."""
    return np.linalg.solve(G + 2.0 * lam * n * np.eye(len(b)), b)


# --- tall-skinny QR ------------------------------------------------------------------------------

_FACTOR_SCHEMA = "key int, i int, vals array<double>, task int"


def fold_in(R: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Triangular factor of the rows behind ``R`` and of ``rows`` together; signs make the diagonal non-negative."""
    out = np.linalg.qr(np.vstack([R, rows]), mode="r")
    out = out * np.where(np.diag(out) < 0, -1.0, 1.0)[:, None]
    return np.vstack([out, np.zeros((rows.shape[1] - len(out), rows.shape[1]))]) if len(out) < rows.shape[1] else out


def _merge_factors(df: DataFrame, group) -> DataFrame:
    """Factors merged by (key, group) as they stream by, in order of task: two factors in memory at a time."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, R, rows = None, None, []

        def done() -> pd.DataFrame:
            return pd.DataFrame({"key": now[0], "i": np.arange(len(R)), "vals": list(R), "task": now[1]})

        def close() -> None:
            nonlocal R, rows
            if rows:
                block = np.stack(rows)
                R, rows = block if R is None else fold_in(R, block), []

        for batch in batches:
            for key, g, i, vals in zip(batch["key"].tolist(), batch["g"].tolist(), batch["i"].tolist(), batch["vals"]):
                if (key, g) != now or i == 0:
                    close()
                    if (key, g) != now:
                        if now is not None:
                            yield done()
                        now, R = (key, g), None
                rows.append(np.asarray(vals))
        if now is not None:
            close()
            yield done()

    keyed = df.withColumn("g", group)
    return keyed.repartition("key", "g").sortWithinPartitions("key", "g", "task", "i").mapInPandas(run, _FACTOR_SCHEMA)


def fold_factors(df: DataFrame, d: int, x_col: str = "x", y_col: str = "y", fold_col: str | None = "fold",
                 shift: np.ndarray | None = None, scale: np.ndarray | None = None) -> dict:
    """{fold: (d+1) x (d+1) upper triangular R with R'R = sum(z z^T)}, z = [x', y], from one pass.

    Nothing is squared on the way. One factor per fold reaches the driver, whatever the number of partitions."""
    sh = np.zeros(d) if shift is None else np.asarray(shift, float)
    sc = np.ones(d) if scale is None else np.asarray(scale, float)

    def kernel(batches):
        held: dict[int, np.ndarray] = {}
        for X, y, keys in iter_xyk(batches, d, x_col, y_col, fold_col):
            Z = np.column_stack([((X if isinstance(X, np.ndarray) else X.dense()) - sh) / sc, y])  # one block at a time
            for k in np.unique(keys):
                held[int(k)] = fold_in(held.get(int(k), np.zeros((0, d + 1))), Z[keys == k])
        yield partial_batch({(k, i): R[i] for k, R in held.items() for i in range(d + 1)})

    from riskspark.session import ship_package
    ship_package(df.sparkSession)
    src = df if is_blocks(df) else df.select(*[c for c in (x_col, y_col, fold_col) if c])
    near = _merge_factors(src.mapInArrow(kernel, PARTIAL_SCHEMA).withColumn("task", F.spark_partition_id()),
                          F.pmod(F.spark_partition_id(), F.lit(FAN)))
    out: dict = {}
    for r in _merge_factors(near, F.lit(0)).collect():
        out.setdefault(r["key"], np.zeros((d + 1, d + 1)))[r["i"]] = r["vals"]
    return out


def combine_factors(factors: dict, exclude: int | None) -> np.ndarray:
    """Factor of all rows but those of one fold."""
    used = [R for k, R in sorted(factors.items()) if k != exclude]
    out = used[0]
    for R in used[1:]:
        out = fold_in(out, R)
    return out


def map_factor(R: np.ndarray, A: np.ndarray) -> np.ndarray:
    """Factor of [A x', y] from the factor of [x', y]."""
    d = A.shape[0]
    return fold_in(np.zeros((0, d + 1)), np.column_stack([R[:, :d] @ A.T, R[:, d]]))


def least_squares_qr(R: np.ndarray, n: float = 0.0, lam: float = 0.0) -> tuple[np.ndarray, float]:
    """E4 (E5 with ``lam``): (weights, sum of squared residuals) from a factor of [x, y].

    Columns that depend on each other to working precision raise numpy.linalg.LinAlgError, as a singular system does."""
    d = R.shape[1] - 1
    top = R if not lam else fold_in(R, np.column_stack([np.sqrt(2.0 * lam * n) * np.eye(d), np.zeros(d)]))
    diag = np.abs(np.diag(top)[:d])
    if d and (diag <= np.finfo(float).eps * d * np.linalg.norm(top[:d, :d], axis=0)).any():
        raise np.linalg.LinAlgError("Singular matrix")
    w = np.zeros(d)
    for j in reversed(range(d)):
        w[j] = (top[j, d] - top[j, j + 1:d] @ w[j + 1:]) / top[j, j]
    residual = R[:, d] - R[:, :d] @ w
    return w, float(residual @ residual)
