"""C4 and the Gram matrix: per-fold moments from one grouped pass.

Per-fold (count, mean, M2) come from Spark's numerically stable built-in
aggregates grouped by fold; the training statistics of fold i (all rows not in
fold i) are merged on the driver with the parallel-variance formula -- k x D
numbers, independent of row count.

Sums of partial vectors have one order, whatever the number of partitions: within
FAN groups of tasks by task number, then over the groups.

The Gram matrix sum(z z^T), z = [x, y], is computed per partition with NumPy
over Arrow batches (BLAS instead of D^2 SQL aggregates) and reduced on the
cluster, split by (key, row of the matrix), so no task or driver ever holds
more than one partition's partial or one reduced row block.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager, nullcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fold_moments(df: DataFrame, cols: Sequence[str], fold_col: str = "fold") -> dict:
    """{fold: (n[D], mean[D], m2[D])} with NULLs skipped per column."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mu"), F.var_pop(c).alias(f"{c}__v")]
    out = {}
    for r in df.groupBy(fold_col).agg(*aggs).collect():
        n = np.array([r[f"{c}__n"] for c in cols], dtype=float)
        mu = np.array([r[f"{c}__mu"] if r[f"{c}__mu"] is not None else 0.0 for c in cols])
        v = np.array([r[f"{c}__v"] if r[f"{c}__v"] is not None else 0.0 for c in cols])
        out[r[fold_col]] = (n, mu, v * n)
    return out


def merge_moments(parts: Sequence[tuple]) -> tuple:
    """Chan et al. pairwise merge of (n, mean, M2) vectors."""
    n = mu = m2 = None
    for pn, pmu, pm2 in parts:
        if n is None:
            n, mu, m2 = pn.copy(), pmu.copy(), pm2.copy()
            continue
        tot = n + pn
        with np.errstate(invalid="ignore", divide="ignore"):
            delta = pmu - mu
            frac = np.where(tot > 0, pn / np.where(tot > 0, tot, 1), 0.0)
            mu = mu + delta * frac
            m2 = m2 + pm2 + delta * delta * n * frac
        n = tot
    return n, mu, m2


def training_scalers(moments: dict, folds: Sequence[int]) -> dict:
    """{fold i: (mean[D], pop std[D]) over all rows whose fold != i}."""
    out = {}
    for i in folds:
        n, mu, m2 = merge_moments([v for f, v in moments.items() if f != i])
        with np.errstate(invalid="ignore", divide="ignore"):
            std = np.sqrt(np.where(n > 0, m2 / np.where(n > 0, n, 1), np.nan))
        out[i] = (mu, std)
    return out


def global_scaler(moments: dict) -> tuple:
    n, mu, m2 = merge_moments(list(moments.values()))
    with np.errstate(invalid="ignore", divide="ignore"):
        std = np.sqrt(np.where(n > 0, m2 / np.where(n > 0, n, 1), np.nan))
    return mu, std


# --------------------------------------------------------------------------
# partial-vector reduction shared by the Gram and the gradient passes

PARTIAL_SCHEMA = T.StructType([
    T.StructField("key", T.IntegerType()),
    T.StructField("i", T.IntegerType()),
    T.StructField("vals", T.ArrayType(T.DoubleType())),
])


def partial_batch(items: dict) -> pa.RecordBatch:
    """{(key, i): 1-D float array} -> Arrow batch in PARTIAL_SCHEMA."""
    keys, rows, vals = [], [], []
    for (k, i), v in items.items():
        keys.append(int(k))
        rows.append(int(i))
        vals.append(np.asarray(v, dtype=float))
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int32()), pa.array(rows, pa.int32()),
         pa.array(vals, pa.list_(pa.float64()))], names=["key", "i", "vals"])


CHUNK = 1024


def chunked(vec: np.ndarray, key: int = 0) -> dict:
    """Split a long partial vector into (key, chunk) pieces so that every reduce
    group holds at most partitions x CHUNK values and groups reduce in parallel."""
    return {(key, c): vec[c * CHUNK:(c + 1) * CHUNK] for c in range(max(1, -(-len(vec) // CHUNK)))}


def unchunk(reduced: dict, key: int = 0) -> np.ndarray:
    parts = sorted((c, v) for (k, c), v in reduced.items() if k == key)
    return np.concatenate([v for _, v in parts])


#: Groups of tasks whose partial vectors are summed before all groups are.
FAN = 64


def _ordered_sum(pdf):
    """Sum of one group's vectors in order of task; the result stands for its group."""
    import pandas as pd
    pdf = pdf.sort_values("task")
    total = pdf["vals"].iloc[0].copy()
    for v in pdf["vals"].iloc[1:]:
        total += v
    return pd.DataFrame({"key": [int(pdf["key"].iloc[0])], "i": [int(pdf["i"].iloc[0])], "vals": [total],
                         "task": [int(pdf["task"].iloc[0]) % FAN]})


_TASK_SCHEMA = T.StructType([*PARTIAL_SCHEMA.fields, T.StructField("task", T.IntegerType())])


def _group_sums(partials: DataFrame) -> DataFrame:
    """Partial vectors summed on the cluster within FAN groups of tasks, by (key, i)."""
    return partials.groupBy("key", "i", F.pmod("task", F.lit(FAN))).applyInPandas(_ordered_sum, schema=_TASK_SCHEMA)


def reduce_partials(partials: DataFrame, n_parts: int | None = None) -> dict:
    """Sum the partial vectors by (key, i) -> {(key, i): np.ndarray}.

    FAN group sums per (key, i) at most reach the driver, and it adds them in order. With at
    most FAN partitions a group is one partition's vector already, so nothing is shuffled and the
    result is the same to the last bit; ``n_parts`` unknown: groups are summed on the cluster."""
    rows = partials.withColumn("task", F.spark_partition_id())
    if n_parts is None or n_parts > FAN:
        rows = _group_sums(rows)
    out: dict = {}
    for r in sorted(rows.collect(), key=lambda r: r["task"]):
        k = (r["key"], r["i"])
        v = np.asarray(r["vals"], dtype=float)
        out[k] = out[k] + v if k in out else v
    return out


def tree_sum(partials: DataFrame) -> dict:
    """``reduce_partials`` with the last step on the cluster too, for wide results such as Gram matrices.

    Only one vector per (key, i) reaches the driver. Nothing asks how many partitions
    there are, so the plan under ``partials`` runs once."""
    sums = _group_sums(partials.withColumn("task", F.spark_partition_id()))
    sums = sums.groupBy("key", "i").applyInPandas(_ordered_sum, schema=_TASK_SCHEMA)
    return {(r["key"], r["i"]): np.asarray(r["vals"], dtype=float) for r in sums.collect()}


BLOCK_SCHEMA = T.StructType([
    T.StructField("n", T.IntegerType()),
    T.StructField("xb", T.BinaryType()),
    T.StructField("yb", T.BinaryType()),
    T.StructField("kb", T.BinaryType()),
])
BLOCK_BYTES = 2 << 20


def pack_blocks(df: DataFrame, x_col: str, d: int, y_col: str = "y", key_col: str = "fold",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Stack rows into instance blocks (n, X bytes, y bytes, key bytes) of about
    ``block_bytes`` each -- one pass. Iterative passes then stream a few large
    buffers per partition instead of converting every array element to Arrow
    (about 3x less transfer time per pass in a local measurement)."""
    rows_per = max(64, block_bytes // (8 * max(d, 1)))

    def kernel(batches):
        xs, ys, ks, held = [], [], [], 0

        def flush():
            X = np.concatenate(xs) if len(xs) > 1 else xs[0]
            y = np.concatenate(ys) if len(ys) > 1 else ys[0]
            k = np.concatenate(ks) if len(ks) > 1 else ks[0]
            return pa.RecordBatch.from_arrays(
                [pa.array([len(y)], pa.int32()), pa.array([X.tobytes()], pa.binary()),
                 pa.array([y.tobytes()], pa.binary()), pa.array([k.tobytes()], pa.binary())],
                names=["n", "xb", "yb", "kb"])

        for b in batches:
            if b.num_rows == 0:
                continue
            X = arrow_matrix(b, x_col, d)
            y = arrow_vector(b, y_col)
            k = arrow_vector(b, key_col, np.int64)
            start = 0
            while start < len(y):
                take = min(rows_per - held, len(y) - start)
                xs.append(X[start:start + take])
                ys.append(y[start:start + take])
                ks.append(k[start:start + take])
                held += take
                start += take
                if held == rows_per:
                    yield flush()
                    xs, ys, ks, held = [], [], [], 0
        if held:
            yield flush()

    from riskspark.session import ship_package
    ship_package(df.sparkSession)
    return df.select(x_col, y_col, key_col).mapInArrow(kernel, BLOCK_SCHEMA)


def is_blocks(df: DataFrame) -> bool:
    return "xb" in df.columns or "vb" in df.columns


def batches_for(df: DataFrame):
    """``single_blocks`` for a frame of blocks that are stored; rows go in Spark's own batches."""
    return single_blocks(df.sparkSession) if is_blocks(df) and df.storageLevel.useMemory else nullcontext()


@contextmanager
def single_blocks(spark):
    """Within it, a pass gets its blocks one by one. A batch of 10,000 rows, Spark's default, would be a task's whole
    partition of blocks, copied from buffer to buffer as these grow. Blocks must be there (counted) before."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def iter_xyk(batches, d: int, x_col: str = "x", y_col: str = "y", key_col: str | None = "fold"):
    """(X, y, key) triples from row batches or instance blocks; X is a NumPy matrix, or a CodedMatrix of coded blocks."""
    for b in batches:
        if b.num_rows == 0:
            continue
        names = b.schema.names
        if "vb" in names:
            from riskspark.operators.grouped import read_grouped
            for block in read_grouped(b, d):
                yield from block.dense()
        elif "xb" in names:
            ns = b.column(0).to_pylist()
            xb, yb, kb = b.column(1), b.column(2), b.column(3)
            coded = "cb" in names
            for i, n in enumerate(ns):
                if coded:
                    from riskspark.operators.coded import read_block
                    X = read_block(xb[i].as_buffer(), b.column(4)[i].as_buffer(), b.column(5)[i].as_buffer(), n, d)
                else:
                    X = np.frombuffer(xb[i].as_buffer(), dtype=np.float64).reshape(n, d)
                y = np.frombuffer(yb[i].as_buffer(), dtype=np.float64)
                k = np.frombuffer(kb[i].as_buffer(), dtype=np.int64)
                yield X, y, k
        else:
            k = arrow_vector(b, key_col, np.int64) if key_col else np.zeros(b.num_rows, dtype=np.int64)
            yield arrow_matrix(b, x_col, d), arrow_vector(b, y_col), k


def arrow_matrix(batch: pa.RecordBatch, col: str, d: int) -> np.ndarray:
    arr = batch.column(batch.schema.get_field_index(col))
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if n == 0:
        return np.zeros((0, d))
    flat = arr.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=float).reshape(n, d)


def arrow_vector(batch: pa.RecordBatch, col: str, dtype=float) -> np.ndarray:
    arr = batch.column(batch.schema.get_field_index(col))
    return np.asarray(arr.to_numpy(zero_copy_only=False), dtype=dtype)


def gram_by_key(df: DataFrame, x_col: str, y_col: str, d: int, key_col: str | None = None,
                shift: np.ndarray | None = None, scale: np.ndarray | None = None) -> dict:
    """{key: (d+1) x (d+1) matrix sum(z z^T)} with z = [(x - shift) / scale, y].

    ``shift`` / ``scale`` (length d, identity where 0 / 1) keep large raw values
    from losing precision in the sums; callers undo them with an affine map."""
    sh = np.zeros(d) if shift is None else np.asarray(shift, dtype=float)
    sc = np.ones(d) if scale is None else np.asarray(scale, dtype=float)
    cols = [x_col, y_col] + ([key_col] if key_col else [])

    def kernel(batches):
        acc: dict = {}
        for X, y, keys in iter_xyk(batches, d, x_col, y_col, key_col):
            coded = not isinstance(X, np.ndarray)
            Z = None if coded else np.column_stack([(X - sh) / sc, y])
            for kv in np.unique(keys):
                if coded:
                    g = X[keys == kv].gram(y[keys == kv], sh, sc)
                else:
                    Zk = Z[keys == kv]
                    g = Zk.T @ Zk
                acc[int(kv)] = acc[int(kv)] + g if int(kv) in acc else g
        items = {}
        for kv, g in acc.items():
            for i in range(g.shape[0]):
                items[(kv, i)] = g[i]
        yield partial_batch(items)

    from riskspark.session import ship_package
    ship_package(df.sparkSession)
    src = df if is_blocks(df) else df.select(*cols)
    out: dict = {}
    for (kv, i), row in tree_sum(src.mapInArrow(kernel, PARTIAL_SCHEMA)).items():
        out.setdefault(kv, np.zeros((d + 1, d + 1)))[i] = row
    return out
