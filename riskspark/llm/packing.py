"""Variable-capacity best-fit packing of texts into training sequences.

Texts are measured in words plus one end mark; a text longer than the largest
permitted length is cut into pieces of that length and a rest, so nothing is lost.
Pieces are dealt evenly into shards of about ``shard_rows``; within a shard they are
taken from the longest down:

* best fit: a piece goes into the open bin that it leaves the least room in;
* if none has room, a bin is opened. All permitted lengths that hold the piece are
  weighed together: each is filled on paper with the longest remaining pieces that
  fit, and the length with the least cost per word packed is opened;
* at the end every bin is cut down to the shortest permitted length that still holds
  its contents.

A shard works on lengths alone, so its memory is a few numbers per piece; a shard
leaves at most a few part-filled bins behind.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import SPACE, ready, written

CAPACITIES = (512, 1024, 2048, 4096)
#: Cost of a sequence besides its length (one step's fixed work, in words).
SEQUENCE_COST = 16
SHARD_ROWS = 50_000


class _Lengths:
    """Multiset of lengths with the largest one not above a bound."""

    def __init__(self, lengths: np.ndarray):
        values, counts = np.unique(lengths, return_counts=True)
        self.values, self.count = values.tolist(), dict(zip(values.tolist(), counts.tolist()))

    def remove(self, length: int) -> None:
        self.count[length] -= 1
        if not self.count[length]:
            del self.count[length]
            self.values.pop(bisect_left(self.values, length))

    def fill(self, room: int) -> int:
        """Words that taking the longest fitting pieces again and again puts into ``room``."""
        used, at = 0, len(self.values)
        while at:
            at = bisect_left(self.values, room - used + 1, 0, at)
            if not at:
                break
            length = self.values[at - 1]
            used += length * min(self.count[length], (room - used) // length)
            at -= 1
        return used


def pack(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, sequence_cost: float = SEQUENCE_COST):
    """(bin, offset, capacity) arrays for ``lengths``, each between 1 and the largest capacity."""
    sizes = np.asarray(lengths, np.int64)
    capacities = sorted(capacities)
    if len(sizes) and (sizes.min() < 1 or sizes.max() > capacities[-1]):
        raise ValueError("lengths must lie between 1 and the largest capacity")
    left = _Lengths(sizes)
    bin_of, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    used: list[int] = []
    room: list[tuple[int, int]] = []  # (free words, bin) of the open bins, ascending
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        left.remove(size)
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            best = min((c for c in capacities if c >= size),
                       key=lambda c: ((c + sequence_cost) / (size + left.fill(c - size)), c))
            free, b = best, len(used)
            used.append(0)
        bin_of[k], offset[k] = b, used[b]
        used[b] += size
        if free > size:
            insort(room, (free - size, b))
    final = np.asarray(capacities)[np.searchsorted(capacities, used)] if used else np.zeros(0, np.int64)
    return bin_of, offset, final[bin_of] if len(sizes) else final


def pack_documents(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, sequence_cost: float = SEQUENCE_COST,
                   shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, piece, piece_start, piece_words, bin_id, bin_offset, bin_capacity), one row per piece.

    piece_start counts words from the text's start; the last piece's end mark is part of
    piece_words. A null or empty text is one piece of one (its end mark). Repeated rows
    and null ids are packed like any row. An empty table gives no rows; further columns
    are ignored. Bin ids are unique over the result.
    """
    spark = docs.sparkSession
    ready(spark)
    largest = int(max(capacities))
    words = F.size(F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), SPACE), lambda w: w != "")) + 1
    measured = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), words.alias("words")), "lengths")
    pieces = measured.select("doc_id", "words", F.posexplode(
        F.sequence(F.lit(0), F.floor((F.col("words") - 1) / largest).cast("int"))).alias("piece", "k"))
    pieces = pieces.select("doc_id", "piece", (F.col("k") * largest).cast("long").alias("piece_start"),
                           F.least(F.lit(largest), F.col("words") - F.col("k") * largest).cast("long").alias("piece_words"))
    total = measured.agg(F.sum(F.ceil(F.col("words") / largest))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_rows))
    # dealt round robin (rows are sorted first, so a repeated task deals them alike); no key, so no hot key
    dealt = pieces.repartition(shards).withColumn("shard", F.spark_partition_id())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = [b for b in batches if len(b)]
        if not whole:
            return
        pdf = pd.concat(whole, ignore_index=True).sort_values(["piece_words", "doc_id", "piece"], ascending=[False, True, True])
        b, offset, capacity = pack(pdf["piece_words"].to_numpy(), capacities, sequence_cost)
        yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "piece": pdf["piece"], "piece_start": pdf["piece_start"],
                            "piece_words": pdf["piece_words"], "bin_id": (pdf["shard"].to_numpy(np.int64) << 32) + b,
                            "bin_offset": offset, "bin_capacity": capacity})

    return dealt.mapInPandas(run, "doc_id long, piece int, piece_start long, piece_words long, "
                                  "bin_id long, bin_offset long, bin_capacity long")
