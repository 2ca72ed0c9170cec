"""B13 without a dense one-hot array: instance blocks of continuous values and category codes.

A code is the layout position of a row's one-hot column (-1: the value has none), so a
categorical column costs one integer a row, however many values it has. Products
with the design matrix become gathers and scatter-adds, the Gram matrix co-occurrence counts:

* X V       : continuous part by BLAS, plus one gathered row of V per categorical column;
* X' R      : continuous part by BLAS, plus R summed by code (bincount);
* [X y]'[X y]: for every position, the rows that hold it, counted by all their other codes
  and summed over the continuous columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators.clean import FeatureLayout

CODED_SCHEMA = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("xb", T.BinaryType()), T.StructField("yb", T.BinaryType()),
                             T.StructField("kb", T.BinaryType()), T.StructField("cb", T.BinaryType()), T.StructField("pb", T.BinaryType())])
BLOCK_ROWS = 8192


class CodedMatrix:
    """n x d matrix: ``values`` (n x p) at ``positions``, and a 1 at every code of ``codes`` (n x q, -1: none)."""

    def __init__(self, values: np.ndarray, positions: np.ndarray, codes: np.ndarray, d: int):
        self.values, self.positions, self.codes, self.d = values, positions, codes, d

    def __len__(self) -> int:
        return len(self.values)

    def __getitem__(self, rows) -> "CodedMatrix":
        return CodedMatrix(self.values[rows], self.positions, self.codes[rows], self.d)

    def __matmul__(self, V: np.ndarray) -> np.ndarray:
        out = self.values @ V[self.positions]
        padded = np.vstack([V, np.zeros((1, V.shape[1]))])  # code -1 reads the last row
        for column in self.codes.T:
            out += padded[column]
        return out

    @property
    def T(self) -> "_Transposed":  # noqa: N802  (as NumPy names it)
        return _Transposed(self)

    def dense(self) -> np.ndarray:
        out = np.zeros((len(self), self.d))
        out[:, self.positions] = self.values
        rows, columns = np.nonzero(self.codes >= 0)
        out[rows, self.codes[rows, columns]] = 1.0
        return out

    def gram(self, y: np.ndarray, shift: np.ndarray, scale: np.ndarray) -> np.ndarray:
        """(d+1) x (d+1) sums of products of [x', y]; only continuous positions may be shifted or scaled."""
        other = np.ones(self.d, bool)
        other[self.positions] = False
        if (shift[other] != 0).any() or (scale[other] != 1).any():
            raise ValueError("one-hot positions are neither shifted nor scaled")
        full = [*self.positions, self.d]
        Z = np.column_stack([(self.values - shift[self.positions]) / scale[self.positions], y])
        out = np.zeros((self.d + 1, self.d + 1))
        out[np.ix_(full, full)] = Z.T @ Z
        spare = np.where(self.codes < 0, self.d + 1, self.codes)  # counted apart and dropped
        for q in range(self.codes.shape[1]):
            column = self.codes[:, q]
            order = np.argsort(column, kind="stable")
            cuts = np.flatnonzero(np.diff(column[order], prepend=-2))
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                p = column[order[a]]
                if p < 0:
                    continue
                rows = order[a:b]
                out[p, :self.d] += np.bincount(spare[rows].ravel(), minlength=self.d + 2)[:self.d]
                sums = Z[rows].sum(axis=0)
                out[p, full] += sums
                out[full, p] += sums
        return out


class _Transposed:
    def __init__(self, matrix: CodedMatrix):
        self.matrix = matrix

    def __matmul__(self, R: np.ndarray) -> np.ndarray:
        m = self.matrix
        out = np.zeros((m.d, R.shape[1]))
        out[m.positions] = m.values.T @ R
        q = m.codes.shape[1]
        if q:
            codes = np.where(m.codes < 0, m.d, m.codes).ravel()
            for k in range(R.shape[1]):
                out[:, k] += np.bincount(codes, weights=np.repeat(R[:, k], q), minlength=m.d + 1)[:m.d]
        return out


def code_columns(layout: FeatureLayout) -> list[Column]:
    """One INT column per categorical source: the layout position of the row's value, -1 if it has none."""
    groups: dict[str, list[tuple[int, object]]] = {}
    for p, fc in enumerate(layout.columns):
        if fc.kind == "onehot":
            groups.setdefault(fc.source, []).append((p, fc.value))
    out = []
    for source, values in groups.items():
        col, code = F.col(source), F.lit(-1)
        for p, v in values:
            code = F.when(col.isNull() if v is None else col.eqNullSafe(F.lit(v)), F.lit(p)).otherwise(code)
        out.append(code.cast("int").alias(source))
    return out


def pack_coded(df: DataFrame, layout: FeatureLayout, key_col: str = "fold", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(y, x: continuous positions in layout order, codes) rows as instance blocks of ``block_rows``."""
    positions = np.array([p for p, fc in enumerate(layout.columns) if fc.kind != "onehot"], np.int32)
    wide = len(positions)

    def block(X, y, k, codes) -> pa.RecordBatch:
        arrays = [pa.array([len(y)], pa.int32())] + [pa.array([v.tobytes()], pa.binary()) for v in (X, y, k, codes, positions)]
        return pa.RecordBatch.from_arrays(arrays, CODED_SCHEMA.names)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from riskspark.operators.moments import arrow_matrix, arrow_vector
        held: list[tuple] = []
        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            codes = b.column(b.schema.get_field_index("codes"))
            q = len(codes[0])
            held.append((arrow_matrix(b, "x", wide), arrow_vector(b, "y"), arrow_vector(b, key_col, np.int64),
                         codes.flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(b.num_rows, q)))
            size += b.num_rows
            if size >= block_rows:
                whole = [np.concatenate(parts) for parts in zip(*held)]
                full = size - size % block_rows
                for a in range(0, full, block_rows):
                    yield block(*[part[a:a + block_rows] for part in whole])
                held, size = [tuple(part[full:] for part in whole)], size - full
        if size:
            yield block(*[np.concatenate(parts) for parts in zip(*held)])

    from riskspark.session import ship_package
    ship_package(df.sparkSession)
    return df.select("x", "y", key_col, "codes").mapInArrow(kernel, CODED_SCHEMA)


def read_block(xb: bytes, cb: bytes, pb: bytes, n: int, d: int) -> CodedMatrix:
    positions = np.frombuffer(pb, np.int32)
    return CodedMatrix(np.frombuffer(xb, np.float64).reshape(n, len(positions)), positions, np.frombuffer(cb, np.int32).reshape(n, -1), d)
