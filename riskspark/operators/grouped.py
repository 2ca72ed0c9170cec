"""Instance blocks for gradient steps: rows sorted by fold, label, 0/1 columns and columns of few values.

A block holds its varying columns as one array per column, and everything that rows share
(fold, y, the columns with nothing but 0 and 1, and columns of few values where that makes the block
smaller) once per group of equal rows. The shared part of a
product with the design matrix is then one number per group and model, and the gradient of these
columns a sum by group, so a step streams and multiplies the varying columns alone. No row is
dropped: a group counts its rows. Where groups would hold hardly two rows each, only constant
columns are shared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GROUPED_SCHEMA = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("vb", T.BinaryType()), T.StructField("pb", T.BinaryType()),
                               T.StructField("sb", T.BinaryType()), T.StructField("gb", T.BinaryType()), T.StructField("yb", T.BinaryType()),
                               T.StructField("kb", T.BinaryType())])
BLOCK_ROWS = 65536
BLOCK_BYTES = 8 << 20
#: Rows that are read back as one dense matrix, and numbers of one product (they stay in the core's cache).
DENSE_ROWS = 16384
PRODUCT = 65536
#: A column with more values than this among a block's first PROBE rows is kept as it is, without a look at its other rows.
FEW, PROBE = 256, 1024


def _sorted_groups(shared: np.ndarray, y: np.ndarray, key: np.ndarray, codes: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows by key, y, the boolean columns ``shared`` and ``codes``, first row of every group)."""
    bits = np.packbits(shared, axis=1)
    words = np.zeros((len(y), -(-max(1, bits.shape[1]) // 8) * 8), np.uint8)
    words[:, :bits.shape[1]] = bits
    keys = [*(codes or []), *words.view(np.uint64).T, y, key]
    order = np.lexsort(keys)
    new = np.zeros(len(y), bool)
    new[0] = True
    for column in keys:
        column = column[order]
        new[1:] |= column[1:] != column[:-1]
    return order, np.flatnonzero(new)


def _few_valued(X: np.ndarray, columns: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(column, its values as codes) of the columns with at most FEW values, fewest values first."""
    found = []
    for j in columns:
        if len(np.unique(X[:PROBE, j])) <= FEW:
            values, codes = np.unique(X[:, j], return_inverse=True)
            if len(values) <= FEW:
                found.append((len(values), int(j), codes.astype(np.uint16)))
    return [(j, codes) for _, j, codes in sorted(found, key=lambda f: f[:2])]


class GroupedBlock:
    """``values`` (p x n) at ``positions``; group g starts at row ``starts[g]`` and has ``fixed[g]`` at
    the other positions, ``y[g]`` and ``key[g]``. Rows are in order of their key."""

    def __init__(self, values, positions, starts, fixed, y, key, d: int):
        self.values, self.positions, self.starts, self.fixed, self.y, self.key, self.d = values, positions, starts, fixed, y, key, d
        self.others = np.setdiff1d(np.arange(d), positions)
        self.counts = np.diff(starts, append=values.shape[1])

    @classmethod
    def of(cls, X: np.ndarray, y: np.ndarray, key: np.ndarray) -> "GroupedBlock":
        shared = ((X == 0) | (X == 1)).all(axis=0)
        order, starts = _sorted_groups(X[:, shared] == 1, y, key)
        if 2 * len(starts) > len(y):
            shared = (X == X[0]).all(axis=0)
            order, starts = _sorted_groups(X[:, shared] == 1, y, key)
        bits, codes = X[:, shared] == 1, []
        for j, column in _few_valued(X, np.flatnonzero(~shared)):
            finer = _sorted_groups(bits, y, key, [column, *codes])
            # one number a row less, against a number more in every group and more groups
            if len(finer[1]) * (shared.sum() + 1) >= len(y) + len(starts) * shared.sum():
                break
            (order, starts), codes, shared[j] = finer, [column, *codes], True
        positions = np.flatnonzero(~shared)
        first = order[starts]
        return cls(np.ascontiguousarray(X[order][:, positions].T), positions, starts, X[first][:, shared], y[first], key[first], X.shape[1])

    def batch(self) -> pa.RecordBatch:
        parts = (self.values, self.positions.astype(np.int32), self.starts.astype(np.int32), self.fixed, self.y, self.key)
        return pa.RecordBatch.from_arrays([pa.array([self.values.shape[1]], pa.int32()),
                                           *[pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in parts]], GROUPED_SCHEMA.names)

    def dense(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(X, y, key) of the rows, some thousands at a time."""
        group = np.repeat(np.arange(len(self.starts)), self.counts)
        for a in range(0, len(group), DENSE_ROWS):
            g = group[a:a + DENSE_ROWS]
            X = np.empty((len(g), self.d))
            X[:, self.positions] = self.values[:, a:a + DENSE_ROWS].T
            X[:, self.others] = self.fixed[g]
            yield X, self.y[g], self.key[g]

    def segments(self) -> Iterator[tuple[int, slice, slice]]:
        """(key, its groups, its rows)."""
        cuts = [0, *(np.flatnonzero(np.diff(self.key)) + 1), len(self.key)]
        edges = np.append(self.starts, self.values.shape[1])
        for a, b in zip(cuts, cuts[1:]):
            yield int(self.key[a]), slice(a, b), slice(edges[a], edges[b])

    def add_gradient(self, V: np.ndarray, b: np.ndarray, val: np.ndarray, residuals, G: np.ndarray, S: np.ndarray, N: np.ndarray) -> None:
        """Add X'R, sum R and the row count of every task whose validation key is another one.

        ``residuals(T, y, tasks)``: R of the tasks (rows of T) at the products T = X V + b; T may be overwritten."""
        for key, groups, rows in self.segments():
            members = np.flatnonzero(val != key)
            if not len(members):
                continue
            X, fixed, counts = self.values[:, rows], self.fixed[groups], self.counts[groups]
            n = X.shape[1]
            N[members] += n
            if not len(X):      # nothing varies within a group: one residual stands for its rows
                shared = np.ascontiguousarray((fixed @ V[self.others][:, members] + b[members]).T)
                sums = residuals(shared, self.y[groups], members) * counts
                G[self.others[:, None], members] += fixed.T @ sums.T
                S[members] += sums.sum(axis=1)
                continue
            y = np.repeat(self.y[groups], counts)
            group = np.repeat(np.arange(len(counts)), counts)
            starts = self.starts[groups] - self.starts[groups][0]
            shared = (fixed @ V[self.others][:, members] + b[members]).T
            own = np.ascontiguousarray(V[self.positions][:, members].T)
            sums, products = np.empty(shared.shape), np.empty(own.shape)
            at_once = max(1, PRODUCT // n)
            T = np.empty((at_once, n))
            for i in range(0, len(members), at_once):
                m = slice(i, min(i + at_once, len(members)))
                t = np.take(shared[m], group, axis=1, out=T[:m.stop - i], mode="clip")
                for j, x in enumerate(X):
                    t += own[m, j:j + 1] * x
                R = residuals(t, y, members[m])
                products[m] = R @ X.T
                np.add.reduceat(R, starts, axis=1, out=sums[m])
            G[self.positions[:, None], members] += products.T
            G[self.others[:, None], members] += fixed.T @ sums.T
            S[members] += sums.sum(axis=1)


def read_grouped(batch: pa.RecordBatch, d: int) -> Iterator[GroupedBlock]:
    for i, n in enumerate(batch.column(0).to_pylist()):
        vb, pb, sb, gb, yb, kb = (batch.column(c)[i].as_buffer() for c in range(1, 7))
        positions, starts = np.frombuffer(pb, np.int32), np.frombuffer(sb, np.int32)
        yield GroupedBlock(np.frombuffer(vb, np.float64).reshape(len(positions), n), positions, starts,
                           np.frombuffer(gb, np.float64).reshape(len(starts), d - len(positions)),
                           np.frombuffer(yb, np.float64), np.frombuffer(kb, np.int64), d)


def is_grouped(df: DataFrame) -> bool:
    return "vb" in df.columns


def pack_grouped(df: DataFrame, x_col: str, d: int, y_col: str = "y", key_col: str = "fold",
                 block_rows: int | None = None) -> DataFrame:
    """Rows as grouped blocks, one pass. Partitions that leave cores idle in a pass's last wave are
    dealt out again, whole blocks each (lost blocks are dealt alike: Spark sorts them first)."""
    rows_per = block_rows or max(64, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(d, 1))))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from riskspark.operators.moments import arrow_matrix, arrow_vector
        held: list[tuple] = []
        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append((arrow_matrix(b, x_col, d), arrow_vector(b, y_col), arrow_vector(b, key_col, np.int64)))
            size += b.num_rows
            if size >= rows_per:
                X, y, k = (np.concatenate(parts) for parts in zip(*held))
                full = size - size % rows_per
                for a in range(0, full, rows_per):
                    yield GroupedBlock.of(X[a:a + rows_per], y[a:a + rows_per], k[a:a + rows_per]).batch()
                held, size = [(X[full:], y[full:], k[full:])], size - full
        if size:
            yield GroupedBlock.of(*(np.concatenate(parts) for parts in zip(*held))).batch()

    from riskspark.session import ship_package
    ship_package(df.sparkSession)
    rows = df.select(x_col, y_col, key_col)
    parts = rows.rdd.getNumPartitions()
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    blocks = rows.mapInArrow(kernel, GROUPED_SCHEMA)
    return blocks if parts % cores == 0 or parts > 4 * cores else blocks.repartition(-(-parts // cores) * cores)


def label_counts(blocks: DataFrame, d: int) -> DataFrame:
    """(key, y, count) of the labels -1 and +1, from the blocks' groups."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, int] = {}
        for batch in batches:
            for block in read_grouped(batch, d):
                for y, key, n in zip(block.y, block.key, block.counts):
                    if y in (-1.0, 1.0):
                        found[int(key), float(y)] = found.get((int(key), float(y)), 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()), pa.array([y for _, y in found], pa.float64()),
                                          pa.array(list(found.values()), pa.int64())], ["key", "y", "n"])

    return blocks.mapInArrow(kernel, "key long, y double, n long").groupBy("key", "y").agg(F.sum("n").alias("n"))
