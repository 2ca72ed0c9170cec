"""Exact substring deduplication by a distributed merge sort of suffixes.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier
(smaller doc_id, or the same text further left).

Which suffixes are sorted. Every window of ``length`` bytes has an anchor: the
rightmost of its ``KMER``-byte strings with the least hash. The anchor depends on the
window's bytes alone, so equal windows have equal anchors at equal places. Neighbouring
windows that share an anchor are one *stretch*; its sort key is the suffix from the
anchor to the stretch's end, then the part before the anchor backwards. Sorting the
stretches by key thus brings together all windows that can be equal.

1. Texts are dealt into blocks. A block lists the hashes of its anchors; lists are
   exchanged by hash range, and every block hears which of its anchors occur elsewhere
   or twice. A stretch whose anchor is unique has no equal window and goes no further
   (duplicate detection on hashed prefixes; a hash that clashes only sends more).
2. Each block sorts the keys of its remaining stretches, settles repeats inside the
   block, and sends one sorted run to each hash range, front-coded: the length of
   the prefix shared with the key before, and the rest.
3. A range merges its runs with a loser tree that keeps, for every run, the length of
   the prefix its head shares with the last key put out. Heads with different shared
   lengths are ordered by these alone; only equal ones are compared, from there on.
   Equal keys: all but the earliest stretch repeat as a whole. Keys of one anchor that
   differ: their windows are compared, in order of place.
4. Blocks collect what repeats and remove it.

An anchor with many different surroundings (a common phrase in a third of all texts)
would fill one range; its stretches are sent window by window, each a key of its own
that is dealt by its own hash. All this is exact at any size; all groups are runs
of a block or a range, never a group of copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import doc_texts, ready

LENGTH = 100
KMER = 48
#: Bytes of text in a block; stretches that one hash range is meant to hold.
BLOCK_BYTES = 4_000_000
RANGE_STRETCHES = 60_000
#: Different surroundings of an anchor from which its windows are sent one by one.
HOT_ANCHOR = 512
BLOCK, NULL = "__block", "__null"
_SLICE = 1 << 19  # positions hashed at a time

_UNIT = np.random.default_rng(41).integers(0, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.random.default_rng(43).integers(0, 2 ** 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def _hash_windows(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes from every position (len - width + 1 of them)."""
    power, size, hashes = _UNIT[data], 1, {}
    while True:
        hashes[size] = power
        if 2 * size > width:
            break
        power = power[:-size] * _STEP[size.bit_length()] + power[size:]
        size *= 2
    out, covered = None, 0
    for size in sorted(hashes, reverse=True):
        if width - covered >= size:
            part = hashes[size][covered:len(data) - width + covered + 1]
            out = part if out is None else out * _STEP[32 + size.bit_length()] + part
            covered += size
    return _mix(out)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (width - size)], values[width - size:]) if width > size else values


_NO_STRETCH = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2


def stretches(text: bytes, length: int, kmer: int) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor, anchor hash, hash of both ends) of the stretches of one text, by place."""
    found = []
    data = np.frombuffer(text, np.uint8)
    choices = length - kmer + 1
    for begin in range(0, max(0, len(data) - length + 1), _SLICE):
        part = data[begin:begin + _SLICE + length - 1]
        if len(part) < length:
            break
        hashes = _hash_windows(part, kmer)
        place = np.arange(len(hashes), dtype=np.uint64)
        low = np.uint64((1 << 20) - 1)
        least = _least((hashes & ~low) | (low - place), choices)  # equal hashes: the rightmost
        anchor = (low - (least & low)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.append(first[1:], len(anchor)) - 1
        spread = _mix(hashes[anchor[first]] + _STEP[2])  # least hashes are small; ranges need them spread out
        ends = _mix(hashes[first] * _STEP[0] + hashes[last + choices - 1] * _STEP[1] + (last - first).astype(np.uint64))
        found.append((first + begin, last + begin, anchor[first] + begin, spread, ends))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else _NO_STRETCH


def key_of(text: bytes, first: int, last: int, anchor: int, length: int) -> bytes:
    """Sort key of a stretch: from the anchor to its end, then backwards to its start, then the turning point."""
    return text[anchor:last + length] + text[first:anchor][::-1] + bytes((anchor - first,))


def window_of(key: bytes, k: int, length: int) -> bytes:
    """Bytes of the ``k``-th window of the stretch with this key."""
    before = key[-1]
    whole = key[-1 - before:-1][::-1] + key[:-1 - before]
    return whole[k:k + length]


def windows_in(key: bytes, length: int) -> int:
    return len(key) - length


# --- front-coded runs ---------------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the longest common prefix, at least ``known`` of which is given."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (differ.bit_length() + 7) // 8


def encode_run(keys: list[bytes]) -> bytes:
    """Sorted keys as shared-prefix lengths, rest lengths and rests."""
    shared, rests, before = [], [], b""
    for key in keys:
        n = common_prefix(before, key)
        shared.append(n)
        rests.append(key[n:])
        before = key
    sizes = np.array([len(keys)], "<u4").tobytes()
    return sizes + bytes(shared) + bytes(map(len, rests)) + b"".join(rests)


def decode_run(run: bytes) -> Iterator[tuple[bytes, int]]:
    """(key, length of the prefix shared with the key before) of a run."""
    n = int(np.frombuffer(run[:4], "<u4")[0])
    shared, sizes, at, key = run[4:4 + n], run[4 + n:4 + 2 * n], 4 + 2 * n, b""
    for same, size in zip(shared, sizes):
        key = key[:same] + run[at:at + size]
        at += size
        yield key, same


class LoserTree:
    """Merges front-coded runs; yields (run, key, length of the prefix shared with the key before)."""

    def __init__(self, runs: list[bytes]):
        self.heads = [decode_run(r) for r in runs]
        self.keys: list[bytes | None] = [None] * len(runs)
        self.shared = [0] * len(runs)  # with the last key put out
        self.width = 1 << max(0, (len(runs) - 1).bit_length())
        self.losers = [-1] * self.width
        for r in range(len(runs)):
            self._advance(r)
        self.winner = self._build(1)

    def _advance(self, r: int) -> None:
        head = next(self.heads[r], None)
        self.keys[r], self.shared[r] = head if head else (None, -1)

    def _build(self, node: int) -> int:
        if node >= self.width:
            return node - self.width if node - self.width < len(self.keys) else -1
        best, other = self._play(self._build(2 * node), self._build(2 * node + 1))
        self.losers[node] = other
        return best

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's shared length is then that with the winner."""
        if a < 0 or self.keys[a] is None:
            return b, a
        if b < 0 or self.keys[b] is None:
            return a, b
        sa, sb = self.shared[a], self.shared[b]
        if sa != sb:  # the one that shares more with the last key comes first; nothing is compared
            return (a, b) if sa > sb else (b, a)
        x, y = self.keys[a], self.keys[b]
        n = common_prefix(x, y, sa)
        if n == len(x) == len(y):
            first = a < b
        else:
            first = n == len(x) or (n < len(y) and x[n] < y[n])
        winner, loser = (a, b) if first else (b, a)
        self.shared[loser] = n
        return winner, loser

    def __iter__(self) -> Iterator[tuple[int, bytes, int]]:
        at = self.winner
        while at >= 0 and self.keys[at] is not None:
            yield at, self.keys[at], self.shared[at]
            self._advance(at)
            node = (at + self.width) // 2
            while node:
                at, self.losers[node] = self._play(at, self.losers[node])
                node //= 2


# --- repeats among stretches --------------------------------------------------------------------


def repeats(group: list[tuple[bytes, tuple]], length: int) -> Iterator[tuple[tuple, int, int]]:
    """(place, first, last) window runs of stretches of one anchor that repeat an earlier window.

    ``group``: (key, place) with place = (doc_id, block, tie, first window), which orders them."""
    if len(group) == 1:
        return
    group = sorted(group, key=lambda g: g[1])
    whole: set[bytes] = set()
    alike = all(g[0] == group[0][0] for g in group)
    seen: set[bytes] = set()
    for key, place in group:
        n = windows_in(key, length)
        if key in whole:
            yield place, 0, n - 1
            continue
        whole.add(key)
        if alike:
            continue
        begin = None
        for k in range(n):
            w = window_of(key, k, length)
            if w in seen:
                begin = k if begin is None else begin
            else:
                seen.add(w)
                if begin is not None:
                    yield place, begin, k - 1
                    begin = None
        if begin is not None:
            yield place, begin, n - 1


def _pack(**columns) -> bytes:
    return b"".join(np.asarray(v, t).tobytes() for v, t in columns.values())


class Block:
    """Texts of a block in order of (doc_id, text), null ids last; with ``length``, also their stretches."""

    def __init__(self, pdf: pd.DataFrame, length: int = 0, kmer: int = 0):
        raw = [t.encode("utf-8", "surrogatepass") for t in pdf["text"]]
        ids = [None if pd.isna(d) else int(d) for d in pdf["doc_id"]]
        order = sorted(range(len(raw)), key=lambda i: (ids[i] is None, ids[i] or 0, raw[i]))
        self.order = order
        self.texts, self.ids = [raw[i] for i in order], [ids[i] for i in order]
        self.rank = [(2 ** 63 - 1 if d is None else d) for d in self.ids]
        self.ties, before = [], {}
        for d in self.ids:  # numbers the rows of one id
            self.ties.append(before.get(d, 0))
            before[d] = self.ties[-1] + 1
        if length:
            parts = [stretches(t, length, kmer) for t in self.texts]
            self.doc = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
            columns = (np.concatenate(x) for x in zip(*(parts or [_NO_STRETCH])))
            self.first, self.last, self.anchor, self.hash, self.ends = columns

    def surroundings(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchor hashes, ascending, and how many different surroundings each has (255 at most).

        An anchor that occurs twice counts as two at least, so that it is not taken for unique."""
        if not len(self.hash):
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        order = np.lexsort((self.ends, self.hash))
        h, e = self.hash[order], self.ends[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        start = np.flatnonzero(new)
        kinds = np.add.reduceat((new | np.concatenate([[True], e[1:] != e[:-1]])).astype(np.int64), start)
        times = np.diff(np.append(start, len(h)))
        return h[start], np.minimum(255, np.where(times > 1, np.maximum(kinds, 2), 1))


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Hash range of each hash; ranges have equal widths of the hash space."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _split_by_range(hashes: np.ndarray, ranges: int) -> Iterator[tuple[int, int, int]]:
    """(range, start, stop) of ascending hashes."""
    if len(hashes):
        r = _range_of(hashes, ranges)
        start = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        yield from zip(r[start].tolist(), start.tolist(), np.append(start[1:], len(r)).tolist())


_PLACE = (("doc", "<i8"), ("tie", "<i4"), ("first", "<i8"))


def _places(payload: bytes, n: int) -> list[tuple[int, int, int]]:
    out, at = [], 0
    for _, t in _PLACE:
        size = np.dtype(t).itemsize * n
        out.append(np.frombuffer(payload[at:at + size], t).tolist())
        at += size
    return list(zip(*out))


def _with_repeats(docs: DataFrame, finish, schema, length: int = LENGTH, kmer: int = KMER,
                  block_bytes: int = BLOCK_BYTES, hot: int = HOT_ANCHOR) -> DataFrame:
    """``finish(block rows, their marks)`` for every block of ``docs``; marks are the runs of windows that repeat.

    ``docs`` has the columns doc_id and text and no null text. It is dealt into blocks
    by one exchange, which all three uses below share."""
    if not 8 <= kmer < length or 2 * length - kmer > 250:
        raise ValueError("need 8 <= kmer < length and 2 * length - kmer <= 250")
    spark = docs.sparkSession
    ready(spark)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-int(total) // block_bytes))
    ranges = max(1, int(total * 2 / (length - kmer + 2) / RANGE_STRETCHES))
    blocks = docs.withColumn(BLOCK, F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.col("text")), F.lit(count)).cast("int"))

    # 1. which anchors occur more than once
    def anchors(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes, kinds = Block(pdf, length, kmer).surroundings()
        rows = [(r, int(pdf[BLOCK].iat[0]), hashes[a:b].tobytes(), kinds[a:b].astype(np.uint8).tobytes())
                for r, a, b in _split_by_range(hashes, ranges)]
        return pd.DataFrame(rows, columns=["range", "block", "hashes", "kinds"])

    def verdicts(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, np.uint64) for x in pdf["hashes"]]
        kinds = np.concatenate([np.frombuffer(x, np.uint8) for x in pdf["kinds"]]).astype(np.int64)
        _, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        sums = np.bincount(inverse, kinds)[inverse]
        told = (sums > 1).astype(np.uint8) + (sums > hot)
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        return pd.DataFrame({"range": pdf["range"], "block": pdf["block"],
                             "told": [x.tobytes() for x in np.split(told.astype(np.uint8), cuts)]})

    lists = blocks.groupBy(BLOCK).applyInPandas(anchors, "range int, block int, hashes binary, kinds binary")
    told = lists.groupBy("range").applyInPandas(verdicts, "range int, block int, told binary")

    # 2. sorted, front-coded runs of the others; what repeats inside the block is settled here
    def runs(pdf: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        columns = ["range", "block", "run", "places"]
        if not len(pdf):
            return pd.DataFrame([], columns=columns)
        b, squeeze = Block(pdf, length, kmer), zstandard.ZstdCompressor(level=1).compress
        block = int(pdf[BLOCK].iat[0])
        distinct = np.unique(b.hash)
        verdict = np.zeros(len(distinct), np.uint8)
        by_range = dict(zip(answer["range"], answer["told"]))
        for r, start, stop in _split_by_range(distinct, ranges):
            verdict[start:stop] = np.frombuffer(by_range[r], np.uint8)
        mine = verdict[np.searchsorted(distinct, b.hash)] if len(distinct) else verdict
        keep: dict[int, list] = {}
        marks = []
        seen: set[bytes] = set()
        seen_windows: set[bytes] = set()
        for i in np.flatnonzero(mine).tolist():  # in order of place: the first of equal keys is the earliest
            d, first, last = int(b.doc[i]), int(b.first[i]), int(b.last[i])
            key = key_of(b.texts[d], first, last, int(b.anchor[i]), length)
            if key in seen:
                marks.append((b.rank[d], b.ties[d], first, 0, last - first))
                continue
            seen.add(key)
            if mine[i] == 1:
                keep.setdefault(int(_range_of(b.hash[i:i + 1], ranges)[0]), []).append((key, b.rank[d], b.ties[d], first))
                continue
            for k in range(last - first + 1):  # hot anchor: every window is a key of its own, in ranges of their own
                one = window_of(key, k, length) + b"\0"
                if one in seen_windows:
                    marks.append((b.rank[d], b.ties[d], first + k, 0, 0))
                    continue
                seen_windows.add(one)
                own = np.frombuffer(hashlib.blake2b(one, digest_size=8).digest(), np.uint64)
                keep.setdefault(ranges + int(_range_of(own, ranges)[0]), []).append((one, b.rank[d], b.ties[d], first + k))
        rows = []
        for r, found in keep.items():
            found.sort()
            _, doc, tie, first = zip(*found)
            rows.append((r, block, squeeze(encode_run([f[0] for f in found])),
                         squeeze(_pack(doc=(doc, "<i8"), tie=(tie, "<i4"), first=(first, "<i8")))))
        if marks:  # settled here; they pass the next step in a range of their own
            rows.append((-1 - block, block, b"", _pack_marks(marks)))
        return pd.DataFrame(rows, columns=columns)

    sent = (blocks.groupBy(BLOCK).cogroup(told.groupBy("block"))
            .applyInPandas(runs, "range int, block int, run binary, places binary"))

    # 3. loser-tree merge of each range
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        blocks_of = pdf["block"].tolist()
        if pdf["range"].iat[0] < 0:
            return pd.DataFrame({"block": pdf["block"], "marks": pdf["places"]})
        spread = zstandard.ZstdDecompressor().decompress
        sorted_runs = [spread(r) for r in pdf["run"]]
        places = [_places(spread(p), int(np.frombuffer(r[:4], "<u4")[0])) for p, r in zip(pdf["places"], sorted_runs)]
        at = [0] * len(places)
        marks: dict[int, list] = {}
        group: list[tuple[bytes, tuple]] = []

        def settle() -> None:
            for (doc, block, tie, place), first, last in repeats(group, length):
                marks.setdefault(block, []).append((doc, tie, place, first, last))

        # keys of one anchor share KMER bytes at least; single windows only matter if they are equal
        least = kmer if pdf["range"].iat[0] < ranges else length + 1
        for r, key, shared in LoserTree(sorted_runs):
            if shared < least:
                settle()
                group.clear()
            doc, tie, first = places[r][at[r]]
            group.append((key, (doc, blocks_of[r], tie, first)))
            at[r] += 1
        settle()
        return pd.DataFrame([(b, _pack_marks(m)) for b, m in marks.items()], columns=["block", "marks"])

    merged = sent.groupBy("range").applyInPandas(merge, "block int, marks binary")
    return blocks.groupBy(BLOCK).cogroup(merged.groupBy("block")).applyInPandas(finish, schema)


def _pack_marks(marks: list[tuple]) -> bytes:
    return np.array(marks, "<i8").reshape(-1, 5).tobytes()


def _covered(size: int, runs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte spans covered by windows first..last of ``runs``."""
    spans: list[list[int]] = []
    for first, last in sorted(runs):
        stop = min(size, last + length)
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], stop)
        else:
            spans.append([first, stop])
    return [(a, b) for a, b in spans]


def _kept(pdf: pd.DataFrame, found: pd.DataFrame, length: int) -> tuple[Block, list[tuple[int, bytes]]]:
    """The block and, for each of its texts, the number of removed spans and the bytes left."""
    b = Block(pdf)
    where = {place: i for i, place in enumerate(zip(b.rank, b.ties))}
    windows: dict[int, list[tuple[int, int]]] = {}
    for payload in found["marks"]:
        for rank, tie, first, low, high in np.frombuffer(payload, "<i8").reshape(-1, 5).tolist():
            windows.setdefault(where[rank, tie], []).append((first + low, first + high))
    out = []
    for i, text in enumerate(b.texts):
        spans = _covered(len(text), windows.get(i, []), length)
        edges = [0, *(x for s in spans for x in s), len(text)]
        out.append((len(spans), b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2])) if spans else text))
    return b, out


def deduplicate(docs: DataFrame, length: int = LENGTH, **settings) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``.

    A null text is an empty one. Null ids come last; rows of one doc_id count as texts of
    their own, in a fixed order, and the first of equal ones is kept. Texts shorter than
    ``length`` lose nothing. An empty table gives no rows; further columns are ignored.
    Strings are judged on the input, not on what is left.
    """
    def digest(pdf: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        b, kept = _kept(pdf, found, length)
        return pd.DataFrame({"doc_id": pd.array(b.ids, "Int64"), "n_bytes": [len(t) for t in b.texts],
                             "n_removed": [len(t) - len(k) for t, (_, k) in zip(b.texts, kept)],
                             "n_spans": [n for n, _ in kept],
                             "kept_sha256": [hashlib.sha256(k).hexdigest() for _, k in kept]})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _with_repeats(doc_texts(docs), digest, schema, length, **settings)


def without_repeats(docs: DataFrame, length: int = LENGTH, **settings) -> DataFrame:
    """``docs`` with the repeated bytes taken out of its texts; all rows and columns stay.

    Bytes of a character that lost some of its bytes go too. n_chars (if there) follows
    the text; a null text stays null, a text that repeats as a whole becomes empty."""
    names = docs.columns

    def rewrite(pdf: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame({n: [] for n in names})
        b, kept = _kept(pdf, found, length)
        out = pdf.iloc[b.order].reset_index(drop=True)
        out["text"] = [None if gone else k.decode("utf-8", "ignore") for gone, (_, k) in zip(out[NULL], kept)]
        if "n_chars" in names:
            out["n_chars"] = [None if t is None else len(t) for t in out["text"]]
        return out[names]

    marked = docs.withColumn(NULL, F.col("text").isNull()).withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema])
    return _with_repeats(marked, rewrite, schema, length, **settings)
