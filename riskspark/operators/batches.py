"""A store of mini-batches that a step reads one batch of.

The rows are put in batches by their exact rank once and written as instance blocks, each
of one batch, in folders by batch (a folder holds neighbouring batches, sorted, once there are
more than MAX_DIRS). A step filters on its folder and batch, so partition pruning and the
row groups' statistics leave the bytes of that batch: what training reads grows with the
number of steps, not with the table. Every loss of ``gd`` can be trained."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators.gd import Task, _affine, gradient_pass
from riskspark.operators.moments import BLOCK_BYTES, arrow_matrix, arrow_vector
from riskspark.session import scratch_path, ship_package

MAX_DIRS = 4096
_SCHEMA = T.StructType([T.StructField("folder", T.IntegerType()), T.StructField("batch", T.LongType()), T.StructField("n", T.IntegerType()),
                        T.StructField("xb", T.BinaryType()), T.StructField("yb", T.BinaryType()), T.StructField("kb", T.BinaryType())])


@dataclass
class BatchStore:
    """``blocks``: (folder, batch, n, xb, yb, kb) as read back; ``n_batches`` whole batches, ``per_folder`` in a folder."""

    blocks: DataFrame
    path: str
    d: int
    n_batches: int
    per_folder: int

    def batch(self, b: int) -> DataFrame:
        """The instance blocks of one batch."""
        picked = (F.col("folder") == F.lit(b // self.per_folder)) & (F.col("batch") == F.lit(b))
        return self.blocks.where(picked).select("n", "xb", "yb", "kb")

    def everything(self) -> DataFrame:
        return self.blocks.select("n", "xb", "yb", "kb")


def write_batches(df: DataFrame, d: int, n_batches: int, path: str | None = None, x_col: str = "x", y_col: str = "y",
                  batch_col: str = "batch", fold_col: str | None = None, block_bytes: int = BLOCK_BYTES) -> BatchStore:
    """Store ``df`` (x, y, batch; see ``gd.exact_batches``) by batch.

    Rows of batch -1 (a remainder) are stored too, for losses over all rows, in a folder of their own."""
    spark = df.sparkSession
    ship_package(spark)
    path = path or scratch_path(spark, f"batches-{uuid.uuid4().hex}")
    per_folder = max(1, -(-n_batches // MAX_DIRS))
    rows_per = max(64, block_bytes // (8 * max(d, 1)))
    folder = F.floor(F.col(batch_col) / per_folder).cast("int")
    rows = df.select(folder.alias("folder"), F.col(batch_col).cast("long").alias("batch"), F.col(x_col).alias("x"),
                     F.col(y_col).cast("double").alias("y"), (F.col(fold_col) if fold_col else F.lit(0)).cast("long").alias("fold"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, now = 0, None

        def flush() -> pa.RecordBatch:
            X, y, k = (np.concatenate(parts) for parts in zip(*held))
            values = [[now[0]], [now[1]], [len(y)], [X.tobytes()], [y.tobytes()], [k.tobytes()]]
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], _SCHEMA.names)

        for b in batches:
            if not b.num_rows:
                continue
            X, y = arrow_matrix(b, "x", d), arrow_vector(b, "y")
            k, number, place = (arrow_vector(b, c, np.int64) for c in ("fold", "batch", "folder"))
            cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(y)]
            for start, stop in zip(cuts, cuts[1:]):
                if now is not None and now[1] != number[start] and held:
                    yield flush()
                    held, size = [], 0
                now = (int(place[start]), int(number[start]))
                while start < stop:
                    take = min(rows_per - size, stop - start)
                    held.append((X[start:start + take], y[start:start + take], k[start:start + take]))
                    size, start = size + take, start + take
                    if size == rows_per:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    # a batch meets in one task: ``size`` rows by definition; the remainder is less than one batch
    blocks = rows.repartition("batch").sortWithinPartitions("folder", "batch").mapInArrow(pack, _SCHEMA)
    blocks.write.partitionBy("folder").parquet(path)
    return read_batches(spark, path, d, n_batches)


def read_batches(spark: SparkSession, path: str, d: int, n_batches: int) -> BatchStore:
    """A store that ``write_batches`` wrote; its folders are listed once."""
    return BatchStore(spark.read.schema(_SCHEMA).parquet(path), path, d, n_batches, max(1, -(-n_batches // MAX_DIRS)))


def fit_batches(store: BatchStore, task: Task, schedule: Sequence[int], initial: np.ndarray | None = None,
                ratio: float = 1.0) -> np.ndarray:
    """E3 for any loss: one step per entry of ``schedule``, each from its batch's mean gradient (plus the L2 term).

    ``ratio``: class ratio of a balanced loss. A batch without rows is a step without effect."""
    w = np.zeros((store.d, 1)) if initial is None else np.array(initial, float).reshape(store.d, 1)
    A, C = _affine([task], store.d)
    ratios = np.array([ratio])
    for b in schedule:
        picked = store.batch(b)
        G, S, _, N = gradient_pass(picked, store.d, [task], w, ratios, n_parts=picked.rdd.getNumPartitions())
        if N[0]:
            w = w - task.gamma * ((A * G + C * S) / N + 2.0 * task.lam * w)
    return w[:, 0]


def loss_of(store: BatchStore, task: Task, w: np.ndarray, ratio: float = 1.0) -> float:
    """Mean loss over every stored row, remainder included (one pass over the store)."""
    _, _, total, n = gradient_pass(store.everything(), store.d, [task], np.asarray(w, float).reshape(-1, 1), np.array([ratio]))
    return float(total[0] / n[0]) if n[0] else float("nan")
