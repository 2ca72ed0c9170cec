"""Deterministic, engine-independent row hashing.

A row's position in a "random permutation" is replaced by a 32-bit key taken
from the md5 of ``"<seed>:<key1>:<key2>..."``. The same value is computed by
Spark (``conv(substr(md5(..)))``) and by any SQL engine with ``md5`` and hex
casts, so splits, folds and samples are reproducible across engines and do not
depend on partitioning (``randomSplit`` does).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32


def hash32(seed, *keys) -> Column:
    """BIGINT in [0, 2^32): first 8 hex digits of md5('seed:k1:k2...')."""
    parts = [F.lit(str(seed))] + [F.col(k).cast("string") if isinstance(k, str) else k.cast("string")
                                  for k in keys]
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash32_value(seed, *keys) -> int:
    """The same key of literal values, on the driver."""
    return int(hashlib.md5(":".join(map(str, (seed, *keys))).encode()).hexdigest()[:8], 16)


def fraction_cut(ratio: float) -> int:
    """Hash keys below this value form the first ``ratio`` share of rows."""
    return int(ratio * HASH_SPACE)
