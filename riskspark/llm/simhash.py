"""SimHash near-duplicates with vantage-point trees.

Fingerprints. A text's A-Z are lower-cased, its words are the runs between
ASCII white space, its shingles ``shingle`` consecutive words joined by single
spaces (repeats included; a shorter text is one shingle, a text without words
has fingerprint zero). A bit is 1 if it is set in over half of the shingles'
XXH64 values (seed 42).

Pairs. The metric is the Hamming distance. The 64 bits are cut into segments,
each with a search radius of 1 or 0, such that two fingerprints within
``distance`` bits lie within the radius on at least one segment (if they did
not, they would differ in more bits than ``distance``). Every segment has a
vantage-point tree:

* Trees are fitted to a bounded sample of the fingerprints, in tasks. A node
  takes the vantage point and the threshold, out of several candidates from its
  own sample, that cut its rows best; nodes are cut until a leaf is expected to
  hold ``LEAF_ROWS`` fingerprints. Only nodes (at most 4,095 a tree) reach the
  driver.
* Every fingerprint goes down every tree. At a node, d = d(x, v): x belongs
  inside if d <= t and outside if d > t. By the triangle bound, what lies within
  the radius of x differs from d by the radius at most, so x is sent to both
  sides only if t < d <= t + radius (the overlap at the boundary); otherwise one
  branch is pruned. Leaves are the shards, named by tree and leaf alone.
* A shard is cut further in its task by vantage points of its own rows, on the
  segment and then on the whole fingerprint (radius ``distance``), until parts
  are small; these are compared bit by bit. What no vantage point can cut (a
  tight cluster) is compared in windows sorted by distance to a vantage point,
  once more by the triangle bound.

Every pair within ``distance`` meets in some shard, so links are exact. A shard
sends back the edges of its own spanning stars instead of all its pairs, and a
shard of more than ``shard_rows`` fingerprints is dealt out as blocks of rows
against blocks of rows, so neither memory nor output grows with the square of
a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import bounded_sample, components, doc_texts, ready, written

#: Fingerprints that the trees are fitted to (about, at most), their depth, the rows a leaf is to hold,
#: vantage points tried at a node, rows of a shard block, and rows that are compared without further cuts.
SAMPLE_ROWS = 65_536
MAX_DEPTH = 11
LEAF_ROWS = 4096
CANDIDATES = 12
SHARD_ROWS = 131_072
_SMALL = 256
#: Rows of one fingerprint beyond which its join is salted.
HOT_ROWS = 50_000


def fingerprint(text: str, shingle: int) -> int:
    """SimHash of one text, as an unsigned 64-bit integer."""
    words = text.encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(shingle, len(words))
    xxh = xxhash.xxh64_intdigest
    hashes = np.array([xxh(joined[a:b], 42) for a, b in zip(starts[:len(words) - width + 1].tolist(),
                                                            ends[width - 1:].tolist())], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 65536):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[part:part + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def with_fingerprint(docs: DataFrame, shingle: int, text_hash: bool = False) -> DataFrame:
    """(doc_id, fp) with fp the fingerprint's 64 bits as a signed long; on request with text_hash, XXH64 of the text."""
    ready(docs.sparkSession)
    further = ["text_hash"] if text_hash else []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": fps.view(np.int64), **{c: batch[c] for c in further}})

    texts = doc_texts(docs)
    if text_hash:
        texts = texts.withColumn("text_hash", F.xxhash64("text"))
    return texts.mapInPandas(run, "doc_id long, fp long" + "".join(f", {c} long" for c in further))


@dataclass(frozen=True)
class Segment:
    """Bits ``shift`` .. ``shift + width - 1`` of a fingerprint, searched within ``radius``."""
    shift: int
    width: int
    radius: int

    def values(self, fps: np.ndarray) -> np.ndarray:
        return (fps >> np.uint64(self.shift)) & np.uint64((1 << self.width) - 1)


def segments(distance: int) -> list[Segment]:
    """Segments over all 64 bits. The sum of (radius + 1) is distance + 1, so two fingerprints outside
    the radius on all of them differ in distance + 1 bits or more. Segments of radius 1 are five bits wider."""
    count = distance // 2 + 1
    ones = distance + 1 - count
    narrow = (64 - 5 * ones) // count
    out, shift = [], 0
    for k in range(count):
        radius = int(k < ones)
        width = narrow + 5 * radius if k < count - 1 else 64 - shift
        out.append(Segment(shift, width, radius))
        shift += width
    return out


def _best_cut(values: np.ndarray, radius: int) -> tuple[np.uint64, int] | None:
    """Vantage point and threshold, out of evenly spaced candidates, that leave the least pairs to compare;
    None if no candidate spares a tenth of them."""
    n, best, least = len(values), None, 0.9 * len(values) ** 2
    for v in values[:: max(1, n // CANDIDATES)][:CANDIDATES]:
        inside = np.cumsum(np.bincount(np.bitwise_count(values ^ v), minlength=65))
        reached = inside[np.minimum(np.arange(len(inside)) + radius, len(inside) - 1)]  # with the overlap
        cost = reached.astype(float) ** 2 + (n - inside).astype(float) ** 2
        t = int(cost.argmin())
        if cost[t] < least and reached[t] < n and inside[t] < n:
            best, least = (v, t), cost[t]
    return best


def fit_tree(values: np.ndarray, radius: int, leaf_rows: float) -> pd.DataFrame:
    """Nodes (vantage, threshold, inside, outside) of a vantage-point tree; leaves have threshold -1.

    ``leaf_rows`` counts rows of ``values``; node 0 is the root."""
    nodes: list[list[int]] = [[0, -1, -1, -1]]
    todo = [(0, values, 0)]
    while todo:
        node, rows, depth = todo.pop()
        cut = _best_cut(rows, radius) if depth < MAX_DEPTH and len(rows) > max(leaf_rows, 2) else None
        if cut is None:
            continue
        v, t = cut
        far = np.bitwise_count(rows ^ v)
        nodes[node] = [int(np.uint64(v).view(np.int64)), t, len(nodes), len(nodes) + 1]
        todo += [(len(nodes), rows[far <= t + radius], depth + 1), (len(nodes) + 1, rows[far > t], depth + 1)]
        nodes += [[0, -1, -1, -1], [0, -1, -1, -1]]
    return pd.DataFrame(nodes, columns=["vantage", "threshold", "inside", "outside"])


def descend(values: np.ndarray, tree: pd.DataFrame, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf): every leaf that each of ``values`` is sent to."""
    vantage = tree["vantage"].to_numpy(np.int64).view(np.uint64)
    threshold, inside, outside = (tree[c].to_numpy(np.int64) for c in ("threshold", "inside", "outside"))
    row, node = np.arange(len(values)), np.zeros(len(values), np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(row):
        ended = threshold[node] < 0
        found.append((row[ended], node[ended]))
        row, node = row[~ended], node[~ended]
        far = np.bitwise_count(values[row] ^ vantage[node]).astype(np.int64)
        near, beyond = far <= threshold[node] + radius, far > threshold[node]
        row, node = (np.concatenate([row[near], row[beyond]]),
                     np.concatenate([inside[node[near]], outside[node[beyond]]]))
    return np.concatenate([f[0] for f in found] or [row]), np.concatenate([f[1] for f in found] or [node])


def fit_trees(fps: DataFrame, distance: int, leaf_rows: int = LEAF_ROWS) -> list[pd.DataFrame]:
    """The trees of all segments, fitted to a sample of about SAMPLE_ROWS of the distinct ``fps`` (fp)."""
    cuts = segments(distance)
    sample = written(bounded_sample(fps.select("fp"), F.col("fp"), SAMPLE_ROWS), "simhash-sample")
    share = sample.count() / max(1, fps.count())
    rows = sample.select("fp", F.explode(F.array(*[F.lit(k) for k in range(len(cuts))])).alias("seg"))

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        cut = cuts[key[0]]
        values = np.sort(pdf["fp"].to_numpy(np.int64)).view(np.uint64)  # any order of the rows gives the same tree
        return fit_tree(cut.values(values), cut.radius, leaf_rows * share).reset_index(names="node").assign(seg=key[0])

    nodes = (rows.groupBy("seg").applyInPandas(fit, "node long, vantage long, threshold long, inside long, outside long, seg int")
             .toPandas().sort_values(["seg", "node"]))
    return [nodes[nodes["seg"] == k] if (nodes["seg"] == k).any() else fit_tree(np.zeros(0, np.uint64), 0, 1)
            for k in range(len(cuts))]


def _shards(fps: DataFrame, trees: list[pd.DataFrame], distance: int) -> DataFrame:
    """(fp, nameless, low, seg, leaf): every shard of the trees that a fingerprint is sent to."""
    cuts = segments(distance)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy(np.int64).view(np.uint64)
            for k, (cut, tree) in enumerate(zip(cuts, trees)):
                row, leaf = descend(cut.values(values), tree, cut.radius)
                yield batch.iloc[row].assign(seg=k, leaf=leaf)

    return fps.select("fp", "nameless", "low").mapInPandas(run, "fp long, nameless boolean, low long, seg int, leaf long")


def _blocks(shards: DataFrame, shard_rows: int) -> DataFrame:
    """Rows of ``shards`` with (i, j): shards of over ``shard_rows`` rows become pairs of blocks i <= j."""
    # a table of the large shards: broadcast while small (Spark checks its size), so that no shard gathers in the join
    large = written(shards.groupBy("seg", "leaf").count()
                    .select("seg", "leaf", F.ceil(F.col("count") / shard_rows).cast("int").alias("blocks")).where("blocks > 1"), "large")
    rows = shards.join(large, ["seg", "leaf"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp", F.lit("block")), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = rows.select(*shards.columns, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    # by all of it: the blocks of a shard go to different tasks
    return cells.repartition("seg", "leaf", "i", "j").sortWithinPartitions("seg", "leaf", "i", "j")


def _stars(values: np.ndarray, distance: int) -> np.ndarray:
    """Edges of the spanning stars of a few ``values``, all compared with all."""
    near = np.bitwise_count(values[:, None] ^ values) <= distance
    if np.count_nonzero(near) == len(values):
        return np.empty((0, 2), np.int64)
    top = np.arange(len(values))
    while True:
        lower = np.where(near, top, len(values)).min(axis=1)
        if (lower == top).all():
            break
        top = lower
    linked = top != np.arange(len(values))
    return np.stack([values[linked], values[top[linked]]], axis=1).view(np.int64)


def cell_links(values: np.ndarray, cut: Segment, distance: int) -> np.ndarray:
    """Edges (as signed longs) that connect exactly the distinct ``values`` within ``distance`` bits,
    as far as they lie within ``cut.radius`` on the segment ``cut``."""
    out, todo = [], [values]
    while todo:
        rows = todo.pop()
        if len(rows) <= _SMALL:
            out.append(_stars(rows, distance))
            continue
        for part, radius in ((cut.values(rows), cut.radius), (rows, distance)):
            best = _best_cut(part, radius)
            if best:
                far = np.bitwise_count(part ^ best[0])
                todo += [rows[far <= best[1] + radius], rows[far > best[1]]]
                break
        else:
            out.append(_window_links(rows, distance))
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def _window_links(values: np.ndarray, distance: int) -> np.ndarray:
    """Edges (as signed longs) of the spanning stars of ``values`` linked within ``distance`` bits.

    Sorted by distance to a vantage point, a value is compared only with those whose
    distance exceeds its own by ``distance`` at most (triangle bound)."""
    if len(values) <= _SMALL and not (np.triu(np.bitwise_count(values[:, None] ^ values) <= distance, 1)).any():
        return np.empty((0, 2), np.int64)
    vantage = values[0]
    far = np.bitwise_count(values ^ vantage)
    order = np.argsort(far, kind="stable")
    v, far = values[order], far[order]
    stop = np.searchsorted(far, far.astype(np.int64) + distance, side="right")
    root = np.arange(len(v))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(v) - 1):
        near = np.flatnonzero(np.bitwise_count(v[a + 1:stop[a]] ^ v[a]) <= distance)
        if len(near):
            roots = {find(a)} | {find(int(b)) for b in np.unique(root[near + a + 1])}
            low = min(roots)
            for r in roots:
                root[r] = low
    tops = np.array([find(x) for x in range(len(v))])
    linked = tops != np.arange(len(v))
    return np.stack([v[linked], v[tops[linked]]], axis=1).view(np.int64)


def fingerprint_links(fps: DataFrame, distance: int, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Edges (a, b) that connect exactly the rows of ``fps`` (fp, nameless, low; fp distinct) within ``distance`` bits.

    a and b are (nameless, low, fp), so the smallest node of a component carries its smallest low."""
    if not 0 <= distance < 16:
        raise ValueError("distance must lie in 0..15")
    ready(fps.sparkSession)
    cuts = segments(distance)
    cells = _blocks(_shards(fps, fit_trees(fps, distance, leaf_rows), distance), shard_rows)

    def links(cell: list[pd.DataFrame]) -> pd.DataFrame:
        pdf = pd.concat(cell, ignore_index=True).sort_values("fp")  # fp is distinct within a cell
        values = pdf["fp"].to_numpy(np.int64)
        edges = cell_links(values.view(np.uint64), cuts[pdf["seg"].iloc[0]], distance)
        a, b = np.searchsorted(values, edges[:, 0]), np.searchsorted(values, edges[:, 1])
        nameless, low = pdf["nameless"].to_numpy(bool), pdf["low"].to_numpy(np.int64)
        return pd.DataFrame({f"{c}{side}": x[at] for side, at in (("a", a), ("b", b))
                             for c, x in (("nameless_", nameless), ("low_", low), ("fp_", values))})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, cell = None, []  # rows come sorted by cell, so one cell is held at a time
        for batch in batches:
            for key, part in batch.groupby(["seg", "leaf", "i", "j"], sort=True):
                if key != name and cell:
                    yield links(cell)
                    cell = []
                name = key
                cell.append(part)
        if cell:
            yield links(cell)

    flat = cells.mapInPandas(run, "nameless_a boolean, low_a long, fp_a long, nameless_b boolean, low_b long, fp_b long")

    def node(side: str):
        return F.struct(*[F.col(f"{c}_{side}").alias(c) for c in ("nameless", "low", "fp")]).alias(side)

    return flat.select(node("a"), node("b")).distinct()


def _with_component(rows: DataFrame, distance: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` (doc_id, fp, ...) with component_id, the smallest doc_id that links reach.

    The components' smallest nodes carry the ids, so ids come back through one join on the fingerprint;
    a fingerprint of over ``hot_rows`` rows is salted there."""
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
                  .select("fp", F.col("least").isNull().alias("nameless"), F.coalesce("least", F.lit(0)).alias("low"),
                          (F.floor(F.col("n") / hot_rows) + 1).cast("int").alias("salts")), "distinct")
    linked = components(fingerprint_links(fps, distance))
    best = F.coalesce("component", F.struct("nameless", "low", "fp"))
    named = (fps.join(linked.select(F.col("node.fp").alias("fp"), "component"), "fp", "left")
             .select("fp", "salts", F.when(~best["nameless"], best["low"]).alias("component_id"), best["fp"].alias("component_fp"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts"))
    # one row per hot fingerprint, at most rows / hot_rows of them; Spark broadcasts it after a check of its size
    hot = written(fps.where("salts > 1").select("fp", "salts"), "hot")
    own = F.pmod(F.xxhash64("doc_id", F.lit("salt")), F.coalesce("salts", F.lit(1))).cast("int")
    return rows.join(hot, "fp", "left").withColumn("salt", own).drop("salts").join(named, ["fp", "salt"]).drop("salt")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    component_id is the smallest doc_id that links of ``distance`` or fewer differing
    bits reach. Null and empty texts have fingerprint zero and link like any other.
    Rows with a null doc_id keep their row; such a row is never the smallest, and a
    component of null ids only has a null component_id. Repeated rows are returned
    as often as they occur. An empty table gives no rows; other columns are ignored.
    """
    rows = written(with_fingerprint(docs, shingle), "fingerprints")
    return (_with_component(rows, distance)
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of each group of near-duplicates in ``docs``, with all columns.

    The row of the smallest doc_id stays (null ids come last); among several rows of
    that id, the one whose text has the smallest hash; among rows that agree in both,
    the one whose JSON form has the smallest hash, so that of equal rows one stays.
    Null and empty texts are one group. An empty table gives no rows.
    """
    rows = written(with_fingerprint(docs, shingle, text_hash=True), "fingerprints")
    # partial counts and minima keep large groups out of the exchange
    keys = (_with_component(rows, distance)
            .groupBy("component_fp", F.col("doc_id").isNull().alias("nameless"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                     F.col("text_hash").alias("hash")).agg((F.count("*") > 1).alias("several")))
    first = keys.groupBy("component_fp").agg(F.min(F.struct("nameless", "id", "hash", "several")).alias("o"))
    first = written(first.select("o.*"), "first")
    ids = F.col("doc_id").cast("long")
    key = {"nameless": ids.isNull(), "id": F.coalesce(ids, F.lit(0)), "hash": F.xxhash64(F.coalesce("text", F.lit("")))}
    whole = docs.select(F.struct(*docs.columns).alias("whole"), *[v.alias(k) for k, v in key.items()])
    kept = whole.join(first, list(key))
    # rows that share id and text are rare; only they are grouped
    single = kept.where(~F.col("several")).select("whole.*")
    chosen = (kept.where("several").groupBy(*key)
              .agg(F.min_by("whole", F.xxhash64(F.to_json("whole"))).alias("whole")).select("whole.*"))
    return single.unionByName(chosen)
