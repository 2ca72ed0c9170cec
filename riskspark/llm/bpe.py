"""Byte-level BPE by dynamic programming over prefixes.

A text is cut into pieces by the tokenizer's pattern; each piece is encoded on its
own. For every prefix of a piece there is exactly one token that ends its
encoding: the token t among those that end there (found by one pass of an Aho-Corasick
automaton over the vocabulary, which supplies the suffix matches) for which the last token of the prefix before t and t
are compatible, i.e. no merge across their border would have come first. The last
tokens are stored per prefix and followed back from the end, which gives the ids
that merging by rank gives, without any merging.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from riskspark.llm.common import doc_texts, ready

#: Pieces whose ids a worker remembers in each of two generations; the older one is dropped first.
CACHE_PIECES = 400_000
#: The byte-level pattern and alphabet of this kind of vocabulary (fixed values).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [(0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: printable ones themselves, the others from 256 up in order."""
    shown = [b for low, high in PRINTABLE for b in range(low, high + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizer:
    """Encoder and decoder for one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = {bytes(alphabet[c] for c in name): i for name, i in spec["model"]["vocab"].items()
                 if all(c in alphabet for c in name)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = {i: b for b, i in vocab.items()}
        self.text_of = dict(self.bytes_of) | {i: s.encode() for s, i in self.special.items()}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> (rank, merged id)
        self.parts: dict[int, tuple[int, int, int]] = {}  # id -> (rank, left, right) that make it
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = (bytes(alphabet[c] for c in x) for x in (left, right))
            made = vocab[a + b]
            self.merge[vocab[a], vocab[b]] = (rank, made)
            self.parts.setdefault(made, (rank, vocab[a], vocab[b]))
        self.whole = {i: self._own(i) for i in self.bytes_of}
        self.right_edge: dict[int, list] = {}
        self.left_edge: dict[int, list] = {}
        self.fits: dict[int, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.automaton = ahocorasick.Automaton()
        for b, i in vocab.items():
            if self.whole[i]:
                self.automaton.add_word(b.decode("latin-1"), (len(b), i))
        self.automaton.make_automaton()
        self.pieces = regex.compile(PATTERN)
        marks = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.split = regex.compile(f"({marks})") if marks else None

    def _own(self, i: int) -> bool:
        """Whether the bytes of token ``i`` merge to ``i`` itself."""
        parts = [self.vocab_byte(b) for b in self.bytes_of[i]]
        while len(parts) > 1:
            ranked = [(self.merge[p][0], k) for k, p in enumerate(zip(parts, parts[1:])) if p in self.merge]
            if not ranked:
                break
            _, k = min(ranked)
            parts[k:k + 2] = [self.merge[parts[k], parts[k + 1]][1]]
        return parts == [i]

    def vocab_byte(self, b: int) -> int:
        if not hasattr(self, "_single"):
            self._single = {v[0]: i for i, v in self.bytes_of.items() if len(v) == 1}
        return self._single[b]

    def _edge(self, token: int, side: int, memo: dict[int, list]) -> list[tuple[int, int]]:
        """(piece, rank at which it is merged away) of the pieces on one edge while ``token`` is built."""
        if token not in memo:
            found, at, until = [], token, 1 << 60
            while True:
                found.append((at, until))
                if at not in self.parts:
                    break
                until, at = self.parts[at][0], self.parts[at][1 + side]
            memo[token] = found
        return memo[token]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` and ``b`` together are encoded as just these two tokens.

        They are not if, while both are built, a piece x at the right edge of a and a piece y
        at the left edge of b stand side by side, merge, and do so before either is merged
        inside its own token. Equal ranks go from left to right: a's own merge comes first,
        b's own one does not.
        """
        for x, x_until in self._edge(a, 1, self.right_edge):
            for y, y_until in self._edge(b, 0, self.left_edge):
                across = self.merge.get((x, y))
                if across and across[0] < x_until and across[0] <= y_until:
                    return False
        return True

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece (no cut by the pattern inside)."""
        data = piece.encode("utf-8").decode("latin-1")
        last = [0] * (len(data) + 1)
        back = [-1] * (len(data) + 1)
        back[0] = 0
        fits, compatible = self.fits, self.compatible
        for end, (size, token) in self.automaton.iter(data):
            end += 1
            if back[end] >= 0:
                continue
            start = end - size
            if start:
                if back[start] < 0:
                    continue
                key = last[start] << 20 | token
                ok = fits.get(key)
                if ok is None:
                    if len(fits) > 2_000_000:
                        fits.clear()
                    ok = fits[key] = compatible(last[start], token)
                if not ok:
                    continue
            last[end], back[end] = token, start
        ids, at = [], len(data)
        while at:
            ids.append(last[at])
            at = back[at]
        return tuple(reversed(ids))

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; the strings of special tokens become their ids, as in the file."""
        out: list[int] = []
        known, extend = self.known, out.extend
        for part in (self.split.split(text) if self.split else (text,)):
            if part in self.special:
                out.append(self.special[part])
                continue
            for piece in self.pieces.findall(part):
                ids = known.get(piece)
                if ids is None:
                    ids = self.older.get(piece) or self.encode_piece(piece)
                    if len(piece) < 64:
                        if len(known) >= CACHE_PIECES:
                            self.older = known
                            known = self.known = {}
                        known[piece] = ids
                extend(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One per worker process and file."""
    return Tokenizer(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text (null: empty list)."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(path)
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.iloc[start:start + 256]
                yield pd.DataFrame({"doc_id": part["doc_id"],
                                    "ids": [np.array(t.encode(x), np.int32) for x in part["text"]]})

    return doc_texts(docs).mapInPandas(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    ready(encoded.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(path)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": [t.decode(list(x)) for x in batch["ids"]]})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")


def round_trip_digest(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, in one pass over the texts.

    A null text is an empty one: no ids, the digests of nothing. Repeated rows are
    returned as often as they occur, a null doc_id stays null, an empty table gives no
    rows, further columns are ignored. The vocabulary file must be readable at ``path``
    on every worker.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(path)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = t.encode(text)
                rows.append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                             hashlib.sha256(t.decode(ids).encode("utf-8")).hexdigest()))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": [r[0] for r in rows],
                                "ids_sha256": [r[1] for r in rows], "decoded_sha256": [r[2] for r in rows]})

    return doc_texts(docs).mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
