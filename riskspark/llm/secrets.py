"""Secret scans through a trigram index, with DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: an
AND of clauses, each an OR of trigram sets that one of the expression's mandatory
strings needs. The index is partitioned by document: bit t of a document's postings
is its entry in the posting list of trigram t (lower-cased text). Intersecting
posting lists is then a bitwise AND on the document's own row, so no posting list
gathers anywhere and no text is shuffled, however common a trigram is. Documents
that satisfy a rule's query are verified with the expression itself; a rule without
mandatory trigrams scans every document.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if its ``value`` group (0: all of it) has ``least`` characters."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 1


#: Base rules first, in the order in which spans of one start are listed. Fixed patterns; those of
#: access and hex have their least length inside, which finds the same spans (their runs are maximal).
RULES = (
    Rule("assign", f"({_either_case('password|passwd|secret|token|api_?key')})"
                   r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
BASE = ("assign", "access", "hex")
_MOST = 64  # strings that a run may stand for before it is cut


def _strings(nodes) -> set[str] | None:
    """All lower-cased strings of a sequence if they are few, else None."""
    found = {""}
    for node in nodes:
        more = _node_strings(node)
        if more is None:
            return None
        found = {a + b for a, b in product(found, more)}
        if len(found) > _MOST:
            return None
    return found


def _node_strings(node) -> set[str] | None:
    kind, arg = node
    if kind is op.LITERAL:
        return {chr(arg).lower()}
    if kind is op.IN and all(k is op.LITERAL for k, _ in arg):
        return {chr(c).lower() for _, c in arg}
    if kind is op.SUBPATTERN:
        return _strings(arg[3])
    if kind is op.BRANCH:
        parts = [_strings(b) for b in arg[1]]
        return None if None in parts else set().union(*parts)
    if kind is op.MAX_REPEAT and arg[1] <= 4:
        inner = _strings(arg[2])
        if inner is None:
            return None
        return {"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(inner, repeat=n)}
    return None


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """AND of ORs of trigram sets that every match of ``pattern`` needs; empty: no mandatory trigram."""
    clauses: list[list[frozenset[str]]] = []

    def close(run: set[str]) -> None:
        if run and min(map(len, run)) >= 3:
            sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in run}
            clauses.append(sorted((a for a in sets if not any(b < a for b in sets)), key=sorted))

    run = {""}
    for node in parser.parse(pattern):
        more = _node_strings(node)
        if more is None and node[0] is op.MAX_REPEAT and node[1][0] >= 1:
            first = _strings(node[1][2])  # at least one occurrence follows at once
            if first is not None and len(first) * len(run) <= _MOST:
                run = {a + b for a, b in product(run, first)}
        if more is None or len(run) * len(more) > _MOST:
            close(run)
            run = {""}
            if more is not None:
                run = more
        else:
            run = {a + b for a, b in product(run, more)}
    close(run)
    return clauses


def _index(rules: tuple[Rule, ...]) -> tuple[list[str], dict[str, list[list[frozenset[str]]]]]:
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    return sorted({t for q in queries.values() for clause in q for need in clause for t in need}), queries


def with_postings(docs: DataFrame, trigrams: list[str], text: str, prefix: str) -> DataFrame:
    """``docs`` with its postings: 60 trigrams to a long column ``prefix``0, ``prefix``1, ..."""
    low = f"{prefix}low"
    out = docs.withColumn(low, F.lower(F.col(text)))
    for word, start in enumerate(range(0, len(trigrams), 60)):
        bits = F.lit(0).cast("long")
        for bit, t in enumerate(trigrams[start:start + 60]):
            bits = bits.bitwiseOR(F.when(F.contains(F.col(low), F.lit(t)), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
        out = out.withColumn(f"{prefix}{word}", bits)
    return out.drop(low)


def _holds(need: frozenset[str], at: dict[str, int], prefix: str) -> Column:
    masks: dict[int, int] = {}
    for t in need:
        masks[at[t] // 60] = masks.get(at[t] // 60, 0) | 1 << at[t] % 60
    found = F.lit(True)
    for word, mask in sorted(masks.items()):
        found = found & (F.col(f"{prefix}{word}").bitwiseAND(F.lit(mask)) == F.lit(mask))
    return found


def _candidate(query: list[list[frozenset[str]]], at: dict[str, int], prefix: str) -> Column:
    found = F.lit(True)
    for clause in query:
        some = F.lit(False)
        for need in clause:
            some = some | _holds(need, at, prefix)
        found = found & some
    return found


def _spans(rule: Rule, rank: int, text: str) -> Column:
    """Array of (start, rank, stop) of the rule's matches, in code points.

    The text is cut into gap, match, gap, match, ..., tail by one expression whose lazy
    gap ends at the leftmost match or at the end; lengths add up to positions."""
    pieces = F.lit(rf"([\s\S]*?)(?:({rule.pattern})|\z)")
    col = F.col(text)
    cut = F.arrays_zip(F.regexp_extract_all(col, pieces, F.lit(1)).alias("gap"),
                       F.regexp_extract_all(col, pieces, F.lit(2)).alias("match"),
                       F.regexp_extract_all(col, pieces, F.lit(2 + rule.value)).alias("value"))
    none = F.array().cast("array<struct<start:int,rank:int,stop:int>>")

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["0"])
        stop = start + F.length(x["1"])
        one = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop")))
        hit = (F.length(x["1"]) > 0) & (F.length(x["2"]) >= rule.least)
        return F.struct(stop.alias("at"), F.when(hit, F.concat(state["found"], one)).otherwise(state["found"]).alias("found"))

    cut = F.transform(cut, lambda x: F.struct(x["gap"].alias("0"), x["match"].alias("1"), x["value"].alias("2")))
    return F.aggregate(cut, F.struct(F.lit(0).alias("at"), none.alias("found")), add, lambda s: s["found"])


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", prefix: str = "__secret_") -> DataFrame:
    """``docs`` with one span array ``prefix``kind per rule; all its columns stay."""
    trigrams, queries = _index(rules)
    at = {t: i for i, t in enumerate(trigrams)}
    out = with_postings(docs, trigrams, text, f"{prefix}p")
    none = F.array().cast("array<struct<start:int,rank:int,stop:int>>")
    for rank, rule in enumerate(rules):
        if queries[rule.kind]:
            wanted = _candidate(queries[rule.kind], at, f"{prefix}p")
        else:
            wanted = F.rlike(F.col(text), F.lit(rule.pattern))  # no mandatory trigram: every text is scanned
        out = out.withColumn(f"{prefix}{rule.kind}", F.when(wanted, _spans(rule, rank, text)).otherwise(none))
    return out.drop(*[f"{prefix}p{w}" for w in range(-(-len(trigrams) // 60))])


def _listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans) for every row of ``docs``.

    A null text is an empty one, without spans. Each row is scanned on its own, so null
    and repeated ids need no care; an empty table gives no rows; further columns are ignored.
    """
    found = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                   F.coalesce(F.col("text"), F.lit("")).alias("text")), rules)
    every = F.flatten(F.array(*[F.col(f"__secret_{r.kind}") for r in rules]))
    base = F.flatten(F.array(*[F.col(f"__secret_{k}") for k in BASE]))
    return found.select("doc_id", *[F.size(f"__secret_{k}").cast("long").alias(f"n_{k}") for k in BASE],
                        F.sha2(_listed(base, rules), 256).alias("base_sha256"), _listed(every, rules).alias("spans"),
                        F.size(every).cast("long").alias("n_spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; overlapping spans become one mark.

    Columns stay as they are, n_chars (if there) follows the text; a null text stays null."""
    found = with_spans(docs, rules)
    names = [f"__secret_{r.kind}" for r in rules]
    spans = F.array_sort(F.flatten(F.array(*[F.col(n) for n in names])))

    def add(state: Column, s: Column) -> Column:
        # text between the end so far and this span, then a mark; a span that overlaps only moves the end
        gap = F.substring(F.col("text"), state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        inside = (s["start"] < state["at"])
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"),
                        F.when(inside, state["out"]).otherwise(F.concat(state["out"], gap, F.lit(mark))).alias("out"))

    clean = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add,
                        lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    out = found.withColumn("text", F.when(F.size(spans) > 0, clean).otherwise(F.col("text"))).drop(*names)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
