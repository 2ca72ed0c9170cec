"""Row selection by deterministic hash keys.

A split is a column, not a copy. ``hash`` mode needs no shuffle at all; the
``exact`` mode reproduces "first int(N * ratio) rows of a permutation" with
two histogram jobs over the 32-bit key (65,536 buckets each) plus a sorted
``limit`` over the few rows sharing the boundary key -- no global window and
no single-task sort. Where every row needs its rank, it is computed on the keys alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.hashing import fraction_cut, hash32


def holdout_seed(seed) -> str:
    return f"holdout:{seed}"


def fold_seed(seed) -> str:
    return f"fold:{seed}"


def fold_column(k: int, seed=1, key: str = "id") -> Column:
    """Fold in 0..k-1; every row is validated exactly once."""
    return F.pmod(hash32(fold_seed(seed), key), F.lit(k)).cast("int")


def holdout_column(ratio: float = 0.8, seed=1, key: str = "id") -> Column:
    """C1/C2 (hash mode): TRUE for the (1 - ratio) share held out."""
    return hash32(holdout_seed(seed), key) >= F.lit(fraction_cut(ratio))


def stride_sample(df: DataFrame, every: int = 50, seed="sample", key: str = "id") -> DataFrame:
    """A3: 1-in-``every`` deterministic subsample of the rows it is applied to."""
    return df.filter(F.pmod(hash32(seed, key), F.lit(every)) == 0)


def rank_boundary(df: DataFrame, m: int, h: str = "__h", key: str = "id"):
    """Boundary (h*, key*) such that exactly ``m`` rows satisfy (h, key) <= (h*, key*).

    Requires (h, key) unique. Returns None when m <= 0 and "all" when m >= rows.
    """
    if m <= 0:
        return None
    hi = F.shiftright(F.col(h), 16)
    hist = sorted((r[0], r[1]) for r in df.groupBy(hi.alias("b")).count().collect())
    total = sum(c for _, c in hist)
    if m >= total:
        return "all"
    before = 0
    bucket = None
    for b, c in hist:
        if before + c >= m:
            bucket = b
            break
        before += c
    inner = sorted((r[0], r[1]) for r in df.filter(hi == bucket).groupBy(F.col(h).alias("v")).count().collect())
    h_star = None
    for v, c in inner:
        if before + c >= m:
            h_star = v
            break
        before += c
    rest = m - before
    tie = df.filter(F.col(h) == F.lit(h_star))
    counted = tie.agg(F.count("*").alias("n"), F.count_distinct(key).alias("keys")).first()
    if counted["n"] != counted["keys"]:
        raise ValueError(f"{counted['n']} rows share {counted['keys']} keys: exact mode needs unique, non-null keys")
    # the rest-th smallest key of the (small) tie group, without collecting rows
    last = tie.select(key).orderBy(key).limit(rest).agg(F.max(key)).first()[0]
    return h_star, last


def boundary_flag(boundary, h: str = "__h", key: str = "id") -> Column:
    if boundary is None:
        return F.lit(False)
    if boundary == "all":
        return F.lit(True)
    h_star, k_star = boundary
    return (F.col(h) < F.lit(h_star)) | ((F.col(h) == F.lit(h_star)) & (F.col(key) <= F.lit(k_star)))


def _narrow_keys(df: DataFrame, seed, key: str, extra=()):
    """(hash, key[, extra]) persisted for the few boundary jobs, so upstream joins
    run once; released by the caller once the boundary literals are known."""
    from pyspark import StorageLevel
    return df.select(hash32(seed, key).alias("__h"), key, *extra).persist(StorageLevel.MEMORY_AND_DISK)


def exact_holdout(df: DataFrame, ratio: float = 0.8, seed=1, key: str = "id") -> DataFrame:
    """C1 exact mode: the first int(N * ratio) rows by (hash, key) are kept for
    training, the rest held out. Adds BOOLEAN ``holdout``."""
    keys = _narrow_keys(df, holdout_seed(seed), key)
    try:
        n = keys.count()
        bound = rank_boundary(keys, int(n * ratio), "__h", key)
    finally:
        keys.unpersist()
    keyed = df.withColumn("__h", hash32(holdout_seed(seed), key))
    return keyed.withColumn("holdout", ~boundary_flag(bound, "__h", key)).drop("__h")


def undersample(df: DataFrame, label: str = "label", seed="balance", key: str = "id") -> DataFrame:
    """Keep every minority-class row and the minority-count smallest-hash rows
    of each other class. Exact counts, skew-safe (no per-class window)."""
    keys = _narrow_keys(df, seed, key, (label,))
    try:
        counts = {r[0]: r[1] for r in keys.groupBy(label).count().collect()}
        if len(counts) < 2:
            return df
        m = min(counts.values())
        bounds = {cls: None if c == m else rank_boundary(keys.filter(F.col(label) == F.lit(cls)), m, "__h", key)
                  for cls, c in counts.items()}
    finally:
        keys.unpersist()
    keyed = df.withColumn("__h", hash32(seed, key))
    cond = F.lit(False)
    for cls, bound in bounds.items():
        flag = F.lit(True) if bound is None else boundary_flag(bound, "__h", key)
        cond = cond | ((F.col(label) == F.lit(cls)) & flag)
    return keyed.filter(cond).drop("__h")


def key_ranks(df: DataFrame, seed, key: str = "id", partitions: int | None = None) -> DataFrame:
    """(key, rank): 0-based place of every key in the permutation ordered by (hash, key); needs unique keys.

    Works on (hash, key) alone. The hash's upper 16 bits cut the keys into ranges whose counts
    (65,536 numbers, whatever the input) give every range its offset; places within a range
    come from a window over it. Hashes are spread evenly over the ranges, so none is hot, and
    nothing depends on how the rows are partitioned, now or later."""
    from pyspark.sql.window import Window

    spark = df.sparkSession
    keys = df.select(hash32(seed, key).alias("__h"), key).withColumn("__range", F.shiftright("__h", 16))
    offsets, running = [], 0
    for part, n in sorted((r[0], r[1]) for r in keys.groupBy("__range").count().collect()):
        offsets.append((part, running))
        running += n
    starts = F.broadcast(spark.createDataFrame(offsets, "__range long, __start long"))
    if partitions:
        keys = keys.repartition(partitions, "__range")
    place = F.row_number().over(Window.partitionBy("__range").orderBy("__h", key)) - 1
    return (keys.withColumn("__place", place).join(starts, "__range")
            .select(key, (F.col("__start") + F.col("__place")).alias("rank")))


def exact_rank(df: DataFrame, seed, key: str = "id", partitions: int | None = None) -> DataFrame:
    """``df`` with BIGINT ``rank``, the 0-based place in the permutation ordered by (hash, key); needs unique keys.

    Ranks are computed on the keys (see ``key_ranks``) and meet the rows in one join on the key,
    planned by size like any other; rows are never sorted into ranges. A null key is a key like any other."""
    ranks = key_ranks(df, seed, key, partitions).withColumnRenamed(key, "__key")
    return df.join(ranks, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")


def exact_folds(df: DataFrame, k: int = 5, seed=1, key: str = "id", remainder: str = "train_only") -> DataFrame:
    """C3 exact mode: ``k`` folds of int(N / k) consecutive rows of the seeded permutation. Adds INT ``fold``.

    The N mod k rows left over: ``train_only`` gives them fold k, which no model validates
    on, so they are trained on in every fold; ``last`` adds them to fold k - 1. With fewer
    rows than folds all rows are left over."""
    if k < 1 or remainder not in ("train_only", "last"):
        raise ValueError("need k >= 1 and remainder 'train_only' or 'last'")
    last = k if remainder == "train_only" else k - 1
    keys = _narrow_keys(df, fold_seed(seed), key)
    try:
        size = keys.count() // k
        # the ends of all folds but the last one's remainder: k bounds, no row moves
        bounds = [rank_boundary(keys, size * (i + 1), "__h", key) for i in range(k)] if size else []
    finally:
        keys.unpersist()
    fold = F.lit(last)
    for i in reversed(range(len(bounds))):
        fold = F.when(boundary_flag(bounds[i], "__h", key), F.lit(i)).otherwise(fold)
    return df.withColumn("__h", hash32(fold_seed(seed), key)).withColumn("fold", fold.cast("int")).drop("__h")


def exact_stride_sample(df: DataFrame, every: int = 50, seed="sample", key: str = "id") -> DataFrame:
    """A3 exact mode: every ``every``-th row (positions 0, every, 2*every, ...) of
    the seeded permutation -- the reference's [::50] on a shuffled order."""
    picked = key_ranks(df, seed, key).filter(F.col("rank") % every == 0).select(F.col(key).alias("__key"))
    return df.join(picked, F.col(key).eqNullSafe(F.col("__key")), "left_semi")
