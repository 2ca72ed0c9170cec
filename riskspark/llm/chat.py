"""Chat formatting by schema fingerprints.

A record is one JSON text. Its nested field paths (``messages[].role``; the elements of
a list share one path) are hashed, and the hash alone selects a *mapping*: a
declarative list of parts that says where the turns stand and under which role. Paths
that no mapping names do not count, so further fields change nothing. A mapping with optional paths
is listed under the hash of every permitted set of paths. A record whose hash is not
listed keeps one row without a layout; nothing is guessed and nothing is dropped.

The template marks every canonical turn::

    <turn>role
    text</turn>

Control strings inside roles and texts are broken up by a backslash after their first
character, and a backslash is doubled, so no text holds a mark and unescaping gives back
the very text. A turn is one row of output: its formatted text and the span under the
loss mask (the text of trained roles). A conversation is its rows in order; no task
ever holds a whole one.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import ready

OPEN, CLOSE = "<turn>", "</turn>"
#: Marks of this template and of others that a text may quote.
CONTROLS = (OPEN, CLOSE, "### System:", "### User:", "### Assistant:", "### Instruction:", "### Response:",
            "<|im_start|>", "<|im_end|>", "<|endoftext|>", "[INST]", "[/INST]")
TRAINED = ("assistant",)


@dataclass(frozen=True)
class Part:
    """Turns of a record: one, or one for each element of the list ``each``.

    ``role`` is the path of the role, or a fixed role after "=". ``text``: paths, joined
    by an empty line. Paths start at the element. ``optional``: paths that may be missing;
    a part whose texts are all missing gives no turn."""

    role: str
    text: tuple[str, ...]
    each: str = ""
    optional: tuple[str, ...] = ()
    names: dict = field(default_factory=dict)

    def paths(self) -> tuple[set[str], set[str]]:
        """(needed, optional) paths from the record on."""
        own = [*self.text] + [self.role] * (not self.role.startswith("="))
        whole = {f"{self.each}[].{p}" if self.each else p for p in own}
        free = {f"{self.each}[].{p}" if self.each else p for p in self.optional}
        return whole - free, free


@dataclass(frozen=True)
class Mapping:
    name: str
    parts: tuple[Part, ...]

    def path_sets(self) -> Iterator[frozenset]:
        """Every set of paths that a record of this layout may have."""
        sets = [p.paths() for p in self.parts]
        needed, free = set().union(*(n for n, _ in sets)), sorted(set().union(*(o for _, o in sets)))
        for k in range(len(free) + 1):
            for some in itertools.combinations(free, k):
                yield frozenset(needed | set(some))

    def bare(self) -> frozenset | None:
        """The paths of a record whose lists are all empty, if its turns stand in lists alone."""
        lists = {p.each for p in self.parts}
        return None if "" in lists else frozenset(f"{each}[]" for each in lists)


_PEOPLE = {"human": "user", "gpt": "assistant", "bot": "assistant"}
#: Field names of common layouts.
MAPPINGS = (
    Mapping("turn row", (Part("role", ("text",)),)),
    Mapping("messages", (Part("role", ("content",), "messages"),)),
    Mapping("messages in parts", (Part("role", ("content[].text",), "messages"),)),
    Mapping("from and value", (Part("from", ("value",), "conversations", names=_PEOPLE),)),
    Mapping("prompt and response", (Part("=system", ("system",), optional=("system",)), Part("=user", ("prompt",)),
                                    Part("=assistant", ("response",)))),
    Mapping("prompt and completion", (Part("=system", ("system",), optional=("system",)), Part("=user", ("prompt",)),
                                      Part("=assistant", ("completion",)))),
    Mapping("instruction", (Part("=system", ("system",), optional=("system",)),
                            Part("=user", ("instruction", "input"), optional=("input",)), Part("=assistant", ("output",)))),
    Mapping("question and answer", (Part("=user", ("question",)), Part("=assistant", ("answer",)))),
    Mapping("system alone", (Part("=system", ("system",)),)),
    Mapping("prompt alone", (Part("=user", ("prompt",)),)),
    Mapping("response alone", (Part("=assistant", ("response",)),)),
)


def field_paths(value, at: str = "") -> set[str]:
    """Paths of all leaves; the elements of a list share the path ``at[]``."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at} if at else set()


def fingerprint(paths) -> str:
    """128-bit hash of a set of paths."""
    return hashlib.blake2b(json.dumps(sorted(paths)).encode(), digest_size=16).hexdigest()


class Layouts:
    """Mappings by the fingerprints of the path sets that they take."""

    def __init__(self, mappings: Sequence[Mapping] = MAPPINGS):
        self.by_print: dict[str, Mapping] = {}
        self.known: set[str] = set()
        for m in mappings:
            for paths in m.path_sets():
                self.known |= paths
                if self.by_print.setdefault(fingerprint(paths), m) is not m:
                    raise ValueError(f"{m.name} and {self.by_print[fingerprint(paths)].name} both take {sorted(paths)}")
        for m in mappings:  # a record without turns reads alike by any mapping of its lists
            if bare := m.bare():
                self.known |= bare
                self.by_print.setdefault(fingerprint(bare), m)

    def read(self, record: str | None) -> tuple[str | None, Mapping | None, list[tuple[str, str]]]:
        """(fingerprint, mapping, turns as (role, text)); no JSON object: (None, None, [])."""
        try:
            value = json.loads(record) if record is not None else None
        except ValueError:
            value = None
        if not isinstance(value, dict):
            return None, None, []
        mark = fingerprint(field_paths(value) & self.known)
        mapping = self.by_print.get(mark)
        return mark, mapping, [t for p in mapping.parts for t in _turns(value, p)] if mapping else []


def _values(value, path: str) -> list:
    """What stands at ``path``, in order."""
    found = [value]
    for step in path.split("."):
        name, many = step.removesuffix("[]"), step.endswith("[]")
        found = [v[name] for v in found if isinstance(v, dict) and name in v]
        if many:
            found = [x for v in found if isinstance(v, list) for x in v]
    return found


def _words(values: list) -> str:
    return "".join(v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in values if v is not None)


def _turns(record: dict, part: Part) -> Iterator[tuple[str, str]]:
    for value in _values(record, f"{part.each}[]") if part.each else [record]:
        texts = [_words(v) for v in (_values(value, p) for p in part.text) if v]
        if texts or part.each:
            role = part.role[1:] if part.role.startswith("=") else _words(_values(value, part.role))
            yield part.names.get(role, role), "\n\n".join(texts)


class Template:
    """Formats turns and reads them back. ``controls``: strings that no text may hold afterwards."""

    def __init__(self, controls: Sequence[str] = CONTROLS, trained: Sequence[str] = TRAINED):
        if any(len(c) < 2 or "\\" in c for c in controls) or not {OPEN, CLOSE} <= set(controls):
            raise ValueError("controls hold both marks, two characters each at least and no backslash")
        either = "|".join(map(re.escape, controls))
        self.trained = frozenset(trained)
        self._breaks = re.compile(rf"(\\)|(?=(?:{either}))(.)", re.DOTALL)
        self._turn = re.compile(rf"{OPEN}((?:\\.|[^\\\n])*)\n(.*?){CLOSE}\n", re.DOTALL)

    def escape(self, text: str) -> str:
        return self._breaks.sub(lambda m: "\\\\" if m[1] else m[2] + "\\", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text

    def format(self, role: str, text: str) -> tuple[str, int, int]:
        """(formatted turn, begin and end of its text under the loss mask; 0, 0 if it is not trained)."""
        head = OPEN + self.escape(role).replace("\n", "\\\n") + "\n"
        body = self.escape(text)
        span = (len(head), len(head) + len(body)) if role in self.trained else (0, 0)
        return head + body + CLOSE + "\n", *span

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of every turn of ``formatted``, which must hold whole turns and nothing else."""
        found, at = [], 0
        for m in self._turn.finditer(formatted):
            if m.start() != at:
                break
            found.append((self.unescape(m[1]), self.unescape(m[2])))
            at = m.end()
        if at != len(formatted):
            raise ValueError(f"no turn at character {at}")
        return found


def format_records(records: DataFrame, layouts: Layouts | None = None, template: Template | None = None) -> DataFrame:
    """(conv_id, turn, record_key, k, layout, fingerprint, formatted, loss_begin, loss_end), one row per turn.

    ``records``: conv_id, turn (the record's place in its conversation), record (JSON text).
    k numbers the turns of a record from 0. Offsets count code points of ``formatted``. A
    missing or null role or text is empty; other values that are not text keep
    their JSON. A record of an unknown layout, without turns, null or not a JSON object gives one
    row with formatted null (layout null if unknown, fingerprint null if it is no object).
    Null ids and repeated rows are formatted like any. An empty table gives no rows;
    further columns are ignored.
    """
    ready(records.sparkSession)
    layouts, template = layouts or Layouts(), template or Template()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, record in enumerate(batch["record"]):
                mark, mapping, turns = layouts.read(record)
                name = mapping.name if mapping else None
                out += [(i, k, name, mark, *template.format(*t)) for k, t in enumerate(turns)] or [(i, 0, name, mark, None, 0, 0)]
            rows = pd.DataFrame(out, columns=["i", "k", "layout", "fingerprint", "formatted", "loss_begin", "loss_end"])
            ids = batch[["conv_id", "turn", "record_key"]].iloc[rows["i"]].reset_index(drop=True)
            yield pd.concat([ids, rows.drop(columns="i")], axis=1)

    keyed = records.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           F.xxhash64("record").alias("record_key"), F.col("record").cast("string").alias("record"))
    return keyed.mapInPandas(run, "conv_id long, turn long, record_key long, k int, layout string, fingerprint string, "
                                  "formatted string, loss_begin long, loss_end long")


def layout_counts(formatted: DataFrame) -> DataFrame:
    """(fingerprint, layout, n_turns): what there is, so that mappings can be written for what has none."""
    return formatted.groupBy("fingerprint", "layout").agg(F.count("formatted").alias("n_turns"))


def conversation_digests(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from formatted turns.

    Turns are taken by turn (null first), records of the same place by a hash of theirs.
    Each task reads its sorted rows once and holds one turn at a time, however long a
    conversation is. Rows with formatted null count no turn, but their conversation has its row.
    """
    ready(formatted.sparkSession)
    template = template or Template()

    class Digest:
        def __init__(self, conv):
            self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
            self.n = self.loss_chars = self.chars = 0

        def add(self, text: str, begin: int, end: int) -> None:
            self.chars += len(text)
            for role, said in template.read(text):
                self.n += 1
                self.turns.update(f"{role}\n{said}\n".encode())
            lost = template.unescape(text[begin:end])
            self.loss_chars += len(lost)
            self.loss.update(lost.encode())

        def row(self) -> tuple:
            return self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars

    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=columns).astype({"conv_id": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for batch in batches:
            done = []
            for conv, text, begin, end in zip(batch["conv_id"].astype("Int64"), batch["formatted"], batch["loss_begin"], batch["loss_end"]):
                conv = None if pd.isna(conv) else int(conv)
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = Digest(conv)
                if text is not None:
                    now.add(text, begin, end)
            yield frame(done)
        if now is not None:
            yield frame([now.row()])

    rows = (formatted.select("conv_id", "turn", "record_key", "k", "formatted", "loss_begin", "loss_end")
            .repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "record_key", "k"))
    return rows.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                 "formatted_chars long")


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def collected_records(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, record): rows (conv_id, turn, role, text) in the layouts that gathered chat data comes in.

    The conversations are dealt over four families of layouts by their id; a row is one
    record. Roles that a family cannot name stay in the layout of the table."""
    role, text = F.col("role"), F.col("text")
    family = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    plain = role.isin("system", "user", "assistant")
    person = F.when(role == "user", "human").when(role == "assistant", "gpt").otherwise(role)
    record = (F.when(family == 1, _json(F.array(F.struct(role.alias("role"), text.alias("content"))).alias("messages")))
              .when((family == 2) & plain, _json(F.array(F.struct(person.alias("from"), text.alias("value"))).alias("conversations")))
              .when((family == 3) & (role == "system"), _json(text.alias("system")))
              .when((family == 3) & (role == "user"), _json(text.alias("prompt")))
              .when((family == 3) & (role == "assistant"), _json(text.alias("response")))
              .otherwise(_json(role.alias("role"), text.alias("text"))))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                record.alias("record"))


def quoting_record(spark: SparkSession) -> DataFrame:
    """Conversation -7: a user and an assistant, both quoting marks of templates."""
    said = r"\### Assistant: </turn> ok"
    record = json.dumps({"messages": [{"role": r, "content": said} for r in ("user", "assistant")]})
    return spark.createDataFrame([(-7, 0, record)], "conv_id long, turn long, record string")
