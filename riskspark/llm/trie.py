"""Prefix trie of conversations by double-array tries.

A turn is an entry of fixed width: a 128-bit digest of (role, text) and the code points of its
text. A conversation is a *path*, its entries in order, so texts never leave the scan and
byte order of paths is lexicographic order of turns. Equal paths become one row with a
count before anything is built.

1. Distinct paths are range-partitioned and sorted. A shard is a run of neighbouring
   paths, hence of prefixes; a prefix that a third of all conversations share is just many shards.
2. A shard numbers its turns densely and packs its paths into a double-array trie: the
   child of node s by turn c is BASE[s] + c, and CHECK there is s. Walking every path through
   the arrays visits the nodes and sums members; sums of subtrees follow parents (CHECK)
   upwards.
3. Only prefixes of a shard's first or last path can occur in other shards too. These
   *spines* (one row a shard) are merged in order of the shards by a sweep with a stack, which
   holds one path and its open children. Everything else is final inside its shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import ready, written

#: Bytes of an entry: 16 of the digest, 4 of the length.
WIDTH = 20
#: Entries that a shard holds (one longer path is a shard of its own), and ids in a piece of a list of members.
SHARD_TURNS = 200_000
PIECE_IDS = 4096
_NO_IDS = hashlib.sha256(b"").hexdigest()


class DoubleArray:
    """Trie over paths of dense ids (0 .. letters - 1), given sorted and distinct.

    Node 0 is the root. ``base`` and ``check`` are the packed arrays; a slot whose check is -1 is free."""

    def __init__(self, paths: list[np.ndarray]):
        size = 1 + sum(map(len, paths))
        self.base = np.zeros(2 * size, np.int64)
        self.check = np.full(2 * size, -1, np.int64)
        self.check[0] = 0
        self._free = 1  # no slot below is free
        todo = [(0, 0, len(paths), 0)]
        while todo:
            node, low, high, depth = todo.pop()
            while low < high and len(paths[low]) == depth:
                low += 1
            if low == high:
                continue
            starts, kids = [low], [int(paths[low][depth])]
            while True:  # the end of every run by bisection: paths are sorted
                a, b, kid = starts[-1], high, kids[-1]
                while a < b:
                    mid = (a + b) // 2
                    if paths[mid][depth] == kid:
                        a = mid + 1
                    else:
                        b = mid
                if a == high:
                    break
                starts.append(a)
                kids.append(int(paths[a][depth]))
            base = self._place(np.asarray(kids))
            self.base[node] = base
            for k, (kid, start) in enumerate(zip(kids, starts)):
                self.check[base + kid] = node
                todo.append((base + kid, start, starts[k + 1] if k + 1 < len(starts) else high, depth + 1))

    def _place(self, kids: np.ndarray) -> int:
        """The least base, from the first free slot on, whose slots for ``kids`` (ascending) are all free."""
        while self._free < len(self.check) and self.check[self._free] >= 0:
            self._free += 1
        base, tries = self._free - int(kids[0]), 0
        while True:
            last = base + int(kids[-1])
            if last >= len(self.check):
                grown = max(last + 1, 2 * len(self.check)) - len(self.check)
                self.check = np.concatenate([self.check, np.full(grown, -1, np.int64)])
                self.base = np.concatenate([self.base, np.zeros(grown, np.int64)])
            taken = self.check[base + kids] >= 0
            if not taken.any():
                return base
            tries += 1
            # crowded places are left behind in growing steps, so that a wide node is placed in few tries
            base += 1 + tries // 8

    def walk(self, path: np.ndarray) -> list[int]:
        """Nodes from the root's child to the path's end; raises KeyError where the path leaves the trie."""
        node, out = 0, []
        for c in path.tolist():
            slot = int(self.base[node]) + c
            if not 0 <= slot < len(self.check) or self.check[slot] != node or slot == 0:
                raise KeyError(c)
            out.append(slot)
            node = slot
        return out


def shard_nodes(paths: list[bytes], counts: list[int], lows: list[int], ends: list[str]) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(closed nodes, spine) of one shard: sorted distinct ``paths`` with members, smallest member and digest of members.

    Closed nodes: parent_spine is the parent's place in the spine, if it stands there, else null and
    parent_conv_id is given. Spine: the prefixes of the first path by depth, then those of the
    last one below the shared part; sums cover closed nodes under each entry and under no deeper one."""
    raw = np.frombuffer(b"".join(paths), f"V{WIDTH}")
    letters, dense = np.unique(raw, return_inverse=True)
    chars_of = np.array([int.from_bytes(x.tobytes()[16:], "big") for x in letters], np.int64)
    # letters are in byte order, so paths of dense ids are sorted like the paths themselves
    cuts = np.cumsum([0] + [len(p) // WIDTH for p in paths])
    routes = [dense[a:b] for a, b in zip(cuts, cuts[1:])]
    trie = DoubleArray(routes)
    slots = np.flatnonzero(trie.check >= 0)
    size = len(trie.check)
    n, low, depth, chars = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64), np.zeros(size, np.int64)
    digest: dict[int, str] = {}
    walked = []
    for route, count, least, end in zip(routes, counts, lows, ends):
        nodes = trie.walk(route)
        walked.append(nodes)
        for d, s in enumerate(nodes, 1):
            depth[s] = d
        on = np.asarray([0, *nodes])
        n[on] += count
        low[on] = np.minimum(low[on], least)
        chars[on[1:]] = chars_of[route]
        digest[int(on[-1])] = end
    first, last = [0, *walked[0]], [0, *walked[-1]]
    shared = sum(a == b for a, b in zip(first, last))
    spine = first + last[shared:]
    place = np.full(size, -1)
    place[spine] = np.arange(len(spine))
    closed = slots[place[slots] < 0]
    parent = trie.check
    children, leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    np.add.at(children, parent[closed], 1)
    leaves[closed[children[closed] == 0]] = 1
    saved[closed] = (n[closed] - 1) * chars[closed]
    deep = closed[np.argsort(depth[closed], kind="stable")]
    edges = np.flatnonzero(np.diff(depth[deep], prepend=-1, append=-1))
    for a, b in reversed(list(zip(edges, edges[1:]))):  # one depth at a time, from below
        at = deep[a:b]
        np.add.at(leaves, parent[at], leaves[at])
        np.add.at(saved, parent[at], saved[at])
    up = place[parent[closed]]
    inside = up < 0
    nodes = pd.DataFrame({"conv_id": low[closed], "depth": depth[closed], "parent_spine": pd.array(up, "Int64"),
                          "parent_conv_id": pd.array(low[parent[closed]], "Int64"), "n_convs": n[closed],
                          "n_children": children[closed], "n_leaves": leaves[closed], "saved_tokens": saved[closed],
                          "ends_sha256": [digest.get(s, _NO_IDS) for s in closed.tolist()]})
    nodes.loc[inside, "parent_spine"] = pd.NA
    nodes.loc[~inside, "parent_conv_id"] = pd.NA
    at = np.asarray(spine)
    entries = [b""] + [paths[0][i:i + WIDTH] for i in range(0, len(paths[0]), WIDTH)]
    entries += [paths[-1][i:i + WIDTH] for i in range((shared - 1) * WIDTH, len(paths[-1]), WIDTH)]
    side = pd.DataFrame({"spine": np.arange(len(at)), "entry": entries, "depth": depth[at], "conv_id": low[at], "n_convs": n[at],
                         "n_children": children[at], "n_leaves": leaves[at], "saved_tokens": saved[at], "chars": chars[at],
                         "ends_sha256": [digest.get(s, _NO_IDS) for s in spine]})
    return nodes, side


_FIELDS = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_SHARD_SCHEMA = ("shard long, spine long, entry binary, chars long, parent_spine long, parent_conv_id long, conv_id long, depth long, "
                 "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
_MERGED_SCHEMA = ("shard long, spine long, parent_conv_id long, conv_id long, depth long, n_convs long, n_children long, "
                  "n_leaves long, saved_tokens long, ends_sha256 string")


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Nodes and spines of a partition's sorted paths, SHARD_TURNS entries at a time."""
    held: list[tuple] = []
    turns, done, part = 0, 0, None

    def flush() -> pd.DataFrame:
        nodes, side = shard_nodes(*map(list, zip(*held)))
        out = pd.concat([nodes, side], ignore_index=True).reindex(columns=[c.split()[0] for c in _SHARD_SCHEMA.split(", ")])
        out["shard"] = (part << 32) + done
        numbers = [c.split()[0] for c in _SHARD_SCHEMA.split(", ") if c.endswith("long")]
        return out.astype({c: "Int64" for c in numbers}).astype({"entry": object}).where(lambda x: x.notna(), None)

    for batch in batches:
        for part, path, n, low, end in zip(batch["part"].tolist(), batch["path"], batch["n"].tolist(), batch["low"].tolist(), batch["ends"]):
            if held and turns + len(path) // WIDTH > SHARD_TURNS:
                yield flush()
                held, turns, done = [], 0, done + 1
            held.append((bytes(path), n, low, end))
            turns += len(path) // WIDTH
    if held:
        yield flush()


class _Open:
    """A shared node on the sweep's stack."""

    def __init__(self, row, entry: bytes):
        self.entry, self.depth, self.chars = entry, int(row.depth), int(row.chars)
        self.n = self.children = self.leaves = self.saved = 0
        self.low, self.ends = int(row.conv_id), _NO_IDS
        self.places: list[tuple[int, int]] = []
        self.below: list[tuple] = []  # rows of finished shared children, which wait for this node's smallest member

    def add(self, row) -> None:
        self.n += int(row.n_convs)
        self.low = min(self.low, int(row.conv_id))
        self.children += int(row.n_children)
        self.leaves += int(row.n_leaves)
        self.saved += int(row.saved_tokens)
        if row.ends_sha256 != _NO_IDS:
            self.ends = row.ends_sha256
        self.places.append((int(row.shard), int(row.spine)))


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge spines, sorted by (shard, spine): finished shared nodes, and for every place in a spine its node's conv_id.

    Shards are in order of paths, so a node is finished once an entry stands where it stood."""
    stack: list[_Open] = []
    columns = [c.split()[0] for c in _MERGED_SCHEMA.split(", ")]
    out: list[tuple] = []

    def close() -> None:
        x = stack.pop()
        leaves = x.leaves if x.children else 1
        saved = x.saved + (x.n - 1) * x.chars
        out.extend((shard, spine, None, x.low, *[None] * 6) for shard, spine in x.places)
        out.extend((None, None, x.low, *row) for row in x.below)
        row = (x.low, x.depth, x.n, x.children, leaves, saved, x.ends)
        if stack:
            up = stack[-1]
            up.children += 1
            up.leaves += leaves
            up.saved += saved
            up.below.append(row)
        else:
            out.append((None, None, None, *row))

    def frame() -> pd.DataFrame:
        made = pd.DataFrame(out, columns=columns).astype({c: "Int64" for c in columns if c != "ends_sha256"})
        out.clear()
        return made

    for batch in batches:
        for row in batch.itertuples(index=False):
            entry, depth = bytes(row.entry), int(row.depth)
            if len(stack) <= depth or stack[depth].entry != entry:
                while len(stack) > depth:
                    close()
                stack.append(_Open(row, entry))
            stack[depth].add(row)
        yield frame()
    while stack:
        close()
    if out:
        yield frame()


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): the entries of every conversation's turns in order of turn, null first.

    Equal turns are ordered by digest. Null roles and texts are empty. Rows without a conv_id belong to no conversation."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    entry = F.concat(digest, F.lpad(F.hex(F.length(text)), 8, "0"))
    turn = F.col("turn").cast("long")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(turn.isNotNull().alias("known"), F.coalesce(turn, F.lit(0)).alias("turn"), entry.alias("entry")).alias("t"))
    path = F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["entry"]), "")
    return rows.groupBy("conv_id").agg(F.unhex(path).alias("path"))


def rebuilt_paths(paths: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """``paths`` with the first h entries taken from conversation c - c % every; h is crc32(c) % most.

    Where that conversation is missing, only the own entries after the first h are left."""
    c = F.col("conv_id")
    heads = (paths.where(c % every == 0)
             .select(c.alias("first"), F.substring("path", 1, WIDTH * (most - 1)).alias("head")))
    h = (F.crc32(c.cast("string").cast("binary")) % most * WIDTH).cast("int")
    own = paths.withColumn("first", c - c % every).withColumn("h", h)
    return own.join(heads, "first", "left").select("conv_id", F.expr(
        "concat(coalesce(substring(head, 1, h), X''), substring(path, h + 1))").alias("path"))


def distinct_paths(paths: DataFrame) -> DataFrame:
    """(path, n, low, ends): members, smallest member and the digest of all members' ids, ascending and comma-joined.

    Ids are joined in pieces of PIECE_IDS neighbouring ids first; the digest runs over the
    pieces of a path in order, so that no task holds the members of a path that many share."""
    ready(paths.sparkSession)
    piece = F.floor(F.col("conv_id") / PIECE_IDS).alias("piece")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = paths.groupBy("path", piece).agg(F.count("*").alias("n"), F.min("conv_id").alias("low"), joined.alias("ids"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, n, low, digest = None, 0, 0, None
        columns = ["path", "n", "low", "ends"]
        for batch in batches:
            done = []
            for p, m, least, ids in zip(batch["path"], batch["n"].tolist(), batch["low"].tolist(), batch["ids"]):
                p = bytes(p)
                if p != path:
                    if path is not None:
                        done.append((path, n, low, digest.hexdigest()))
                    path, n, low, digest = p, 0, least, hashlib.sha256()
                elif n:
                    digest.update(b",")
                n += m
                digest.update(ids.encode())
            yield pd.DataFrame(done, columns=columns)
        if path is not None:
            yield pd.DataFrame([(path, n, low, digest.hexdigest())], columns=columns)

    return (pieces.repartition("path").sortWithinPartitions("path", "piece")
            .mapInPandas(run, "path binary, n long, low long, ends string"))


def trie_nodes(paths: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per node.

    ``paths``: conv_id (distinct, not null) and path (entries of WIDTH bytes). The root has depth 0 and
    no parent; a conversation without turns ends there. An empty table gives no rows."""
    ready(paths.sparkSession)
    distinct = written(distinct_paths(paths), "trie-paths")
    sorted_paths = distinct.repartitionByRange("path").sortWithinPartitions("path")
    made = written(sorted_paths.select(F.spark_partition_id().alias("part"), "path", "n", "low", "ends")
                   .mapInPandas(_shards, _SHARD_SCHEMA), "trie-shards")
    # one row per shard and depth of its first and last path
    spines = made.where("spine is not null").drop("parent_spine", "parent_conv_id")
    merged = written(spines.repartition(1).sortWithinPartitions("shard", "spine").mapInPandas(_sweep, _MERGED_SCHEMA), "trie-spines")
    places = merged.where("shard is not null").select("shard", F.col("spine").alias("parent_spine"), F.col("conv_id").alias("up"))
    closed = made.where("spine is null")
    columns = ["conv_id", "depth", "parent_conv_id", *_FIELDS[2:]]
    inside = closed.where("parent_spine is null").select(columns)
    below = (closed.where("parent_spine is not null").drop("parent_conv_id").join(places, ["shard", "parent_spine"])
             .withColumnRenamed("up", "parent_conv_id").select(columns))
    return inside.unionByName(below).unionByName(merged.where("shard is null").select(columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie (see ``trie_nodes``) of rebuilt conversations (see ``rebuilt_paths``).

    Null roles and texts are empty, rows with a null conv_id are in no conversation, repeated rows are
    repeated turns, further columns are ignored. A conversation's entries (20 bytes a turn) meet in one
    task; texts never do."""
    return trie_nodes(rebuilt_paths(written(conversation_paths(conversations), "conversation-paths")))
