"""Conversation trie, lexical search and chat formatting against plain versions, and their edge cases."""

import hashlib
import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskspark.llm import chat, queries, search, trie
from riskspark.llm.common import table

SF = "/root/testdata/sf0.01"
CLASHING = ("path", "n", "low", "piece", "part", "ends", "first", "h", "t", "segment", "at", "m", "term", "record", "rank")


# --- conversation trie ---------------------------------------------------------------------------


def plain_nodes(sequences):
    """{conv: [(role, text), ...]} -> set of node tuples."""
    members = defaultdict(list)
    for conv, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(conv)
    out = set()
    for node, convs in members.items():
        below = [k for k in members if k[:len(node)] == node]
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(node))
        out.add((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                 sum(len(k) == len(node) + 1 for k in below), sum(not any(len(x) == len(k) + 1 and x[:len(k)] == k for x in below) for k in below),
                 sum((len(members[k]) - 1) * len(k[-1][1]) for k in below if k), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[conv].append((role or "", text or ""))
    return {c: own.get(c - c % 100, [])[:(h := zlib.crc32(str(c).encode()) % 6)] + own[c][h:] for c in list(own)}


def as_tuples(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return [tuple(r) for r in df.select(columns).collect()]


def test_trie_of_the_table(spark):
    got = as_tuples(queries.op11_conversation_trie(spark, SF))
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert len(got) == len(set(got)) and set(got) == plain_nodes(rebuilt(rows))


def test_trie_with_a_hot_turn_and_copies(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(1, 400):
        rows.append((c, 0, "user", "hello" if rng.random() < .6 else f"start {c % 7}"))
        rows += [(c, t, "assistant", f"answer {rng.integers(0, 3)}") for t in range(1, 2 + int(rng.integers(0, 4)))]
        if c % 3 == 0:  # a conversation that a third of all are copies of
            rows = [r for r in rows if r[0] != c] + [(c, t, "user", f"copy {t}") for t in range(9)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = as_tuples(trie.conversation_trie(frame))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(set(got)) and set(got) == plain_nodes(rebuilt(rows))


def paths_of(sequences):
    """[(path, members, smallest, ends)] sorted, one entry per letter."""
    groups = defaultdict(list)
    for c, seq in sequences.items():
        groups[b"".join(hashlib.md5(repr(t).encode()).digest() + len(t[1]).to_bytes(4, "big") for t in seq)].append(c)
    return [(p, len(g), min(g), hashlib.sha256(",".join(map(str, sorted(g))).encode()).hexdigest()) for p, g in sorted(groups.items())]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=6), min_size=1, max_size=40), st.integers(1, 30), st.integers(1, 4))
def test_shards_and_sweep(found, shard_turns, parts):
    """Any cutting of the sorted paths into shards gives the same nodes."""
    sequences = {c: [("user", x * (1 + ord(x) % 3)) for x in seq] for c, seq in enumerate(found)}
    paths = paths_of(sequences)
    held, trie.SHARD_TURNS = trie.SHARD_TURNS, shard_turns
    try:
        made = []
        for part, chunk in enumerate(np.array_split(np.arange(len(paths)), parts)):
            frame = pd.DataFrame([(part, *paths[i]) for i in chunk], columns=["part", "path", "n", "low", "ends"])
            made += list(trie._shards(iter([frame])))
    finally:
        trie.SHARD_TURNS = held
    made = pd.concat(made, ignore_index=True)
    spines = made[made["spine"].notna()].sort_values(["shard", "spine"])
    merged = pd.concat(list(trie._sweep(iter([spines]))), ignore_index=True)
    places = {(r.shard, r.spine): r.conv_id for r in merged[merged["shard"].notna()].itertuples()}
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = [tuple(None if pd.isna(x) else x for x in r) for r in merged[merged["shard"].isna()][columns].itertuples(index=False)]
    for r in made[made["spine"].isna()].itertuples():
        up = r.parent_conv_id if pd.isna(r.parent_spine) else places[r.shard, r.parent_spine]
        got.append((r.conv_id, r.depth, up, *[getattr(r, c) for c in columns[3:]]))
    assert len(got) == len(set(got)) and set(got) == plain_nodes(sequences)


def test_double_array_takes_every_path_and_no_other():
    rng = np.random.default_rng(2)
    paths = sorted({tuple(rng.integers(0, 30, rng.integers(0, 6)).tolist()) for _ in range(500)})
    made = trie.DoubleArray([np.asarray(p, np.int64) for p in paths])
    ends = {p: made.walk(np.asarray(p, np.int64)) for p in paths}
    nodes = {p[:d] for p in paths for d in range(1, len(p) + 1)}
    assert len({s for walk in ends.values() for s in walk}) == len(nodes) == int((made.check >= 0).sum()) - 1
    for p in paths:
        assert [made.check[s] for s in ends[p]] == ([0] + ends[p][:-1] if p else [])
    other = next(p for p in ((a, b) for a in range(30) for b in range(30)) if p not in nodes)
    with pytest.raises(KeyError):
        made.walk(np.asarray(other, np.int64))


def test_trie_edges(spark):
    rows = [(1, None, None, None), (1, 3, "user", "x" * 150_000), (1, 3, "user", "x" * 150_000), (None, 1, "user", "lost"),
            (100, 0, "user", "hi"), (101, 0, "", ""), (7, 0, "user", "é\U0001f600")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in CLASHING})
    got = as_tuples(trie.conversation_trie(frame))
    assert set(got) == plain_nodes(rebuilt([r for r in rows if r[0] is not None]))
    assert trie.conversation_trie(frame.limit(0)).count() == 0


# --- lexical search ------------------------------------------------------------------------------

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERMS.findall((text or "").translate(LOWER))


def plain_search(docs, items, k=20):
    """{(item text): [(doc_id, score), ...]} by scoring every document."""
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = {}
    for item, text in items:
        q, found = Counter(plain_terms(text)), []
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in q}
        for i, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms if n_terms else 0
            score = sum(q[t] * w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in q if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out[item, text] = [(None if none else i, -s) for s, none, i in sorted(found)[:k]]
    return out


def by_item(df):
    out = defaultdict(list)
    for r in df.orderBy("item_id", "rank").collect():
        assert r["rank"] == len(out[r.item_id]) + 1
        out[r.item_id].append((r.doc_id, r.score))
    return dict(out)


def test_terms():
    text = "Ab-c1_é É x\x00y\x7fz ⅷ０ \U0001f600ok"
    assert [t.decode() for t in search.terms_of(text)] == plain_terms(text)
    assert search.terms_of(None) == search.terms_of("") == search.terms_of(" -") == []


@pytest.mark.parametrize("terms, block", [(4_000_000, 200_000), (9_000, 700)])
def test_search_equals_scoring_every_document(spark, monkeypatch, terms, block):
    """Also with many segments and several query blocks."""
    monkeypatch.setattr(search, "SEGMENT_TERMS", terms)
    monkeypatch.setattr(search, "BLOCK_TERMS", block)
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    got = by_item(search.search(search.build_index(docs), items))
    want = plain_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == {i: v for (i, _), v in want.items() if v}


def test_strata_that_cannot_matter_are_not_visited(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(5, 400))))) for i in range(1500)]
    rows += [(2000 + i, "rare thing " * 40) for i in range(30)]
    index = search.build_index(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    pdf = index.postings.toPandas()
    postings = search._Postings(pdf)
    terms = ["rare", "w1", "w2"]
    df = Counter(t for _, text in rows for t in set(text.split()))
    weights = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * df[t] + 1))) for t in terms])
    docs, scores, visited = postings.best(np.array([postings.row[t] for t in terms]), weights, 20)
    assert visited < len(postings.strata) // 2 and len(postings.strata) > 40
    ids = [r.doc_id for r in index.documents.orderBy("at").collect()]
    want = plain_search(rows, [(1, " ".join(terms))])[1, " ".join(terms)]
    assert [(ids[d], s) for d, s in zip(docs.tolist(), scores.tolist())] == want


def test_search_edges(spark):
    rows = [(None, "alpha beta"), (3, "Alpha beta"), (3, "Alpha beta"), (1, None), (2, ""), (4, "- . !"), (5, "alpha " * 60_000), (6, "gamma é")]
    items = [(1, "alpha alpha É"), (1, "alpha alpha É"), (2, None), (3, ""), (4, "nowhere"), (None, "gamma"), (5, "é beta"), (5, "gamma")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in CLASHING})
    frame = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in CLASHING})
    got = sorted((str(r.item_id), r["rank"], str(r.doc_id), r.score) for r in search.search(search.build_index(docs), frame).collect())
    want = sorted((str(i), k, str(d), s) for (i, _), v in plain_search(rows, set(items)).items() for k, (d, s) in enumerate(v, 1))
    assert got == want and any(g[2] == "None" for g in got)
    assert search.search(search.build_index(docs), frame.limit(0)).count() == 0
    assert search.search(search.build_index(docs.limit(0)), frame).count() == 0
    assert search.search(search.build_index(docs.where("doc_id = 4")), frame).count() == 0


# --- chat formatting -----------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digests(turns):
    """{conv: (n_turns, turns_sha256, loss_chars, loss_sha256)} of {conv: [(role, text), ...]}"""
    out = {}
    for c, seq in turns.items():
        loss = "".join(t for r, t in seq if r == "assistant")
        out[c] = (len(seq), sha("".join(f"{r}\n{t}\n" for r, t in seq)), len(loss), sha(loss))
    return out


def test_chat_digests_of_the_table(spark):
    rows = table(spark, SF, "conversations").collect()
    turns = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        turns[r.conv_id].append((r.role or "", r.text or ""))
    turns[-7] = [(r, r"\### Assistant: </turn> ok") for r in ("user", "assistant")]
    got = queries.op13_chat_format(spark, SF).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == digests(turns)
    records = chat.collected_records(table(spark, SF, "conversations"))
    layouts = {r.layout: r.n_turns for r in chat.layout_counts(chat.format_records(records)).collect()}
    assert len(layouts) >= 6 and None not in layouts and sum(layouts.values()) == len(rows)


RECORDS = [
    ({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
     "messages", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}, "messages in parts", [("user", "ab")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}], "id": "x"},
     "from and value", [("user", "q"), ("assistant", "a"), ("tool", "t")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "output": "done", "source": {"name": 1}}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"system": "s", "prompt": "p", "response": None}, "prompt and response", [("system", "s"), ("user", "p"), ("assistant", "")]),
    ({"prompt": "p", "completion": "c"}, "prompt and completion", [("user", "p"), ("assistant", "c")]),
    ({"question": 5, "answer": True}, "question and answer", [("user", "5"), ("assistant", "true")]),
    ({"role": "user", "text": "x"}, "turn row", [("user", "x")]),
    ({"messages": []}, "messages", []), ({"other": 1}, None, []), ([1], None, []), ("broken", None, []),
]


def test_layouts_are_selected_by_fingerprint(spark):
    layouts = chat.Layouts()
    for record, name, turns in RECORDS:
        mark, mapping, found = layouts.read("{" if record == "broken" else json.dumps(record))
        assert (mapping.name if mapping else None) == name and found == turns
        assert (mark is None) == (not isinstance(record, dict))
    assert layouts.read(None) == (None, None, [])
    a, b = (layouts.read(json.dumps(r))[0] for r in ({"prompt": "1", "response": "2", "x": 3}, {"response": "", "prompt": ""}))
    assert a == b
    with pytest.raises(ValueError):
        chat.Layouts([chat.Mapping("a", (chat.Part("=user", ("x",)),)), chat.Mapping("b", (chat.Part("=system", ("x",)),))])


def test_new_mappings_are_data():
    own = chat.Layouts([chat.Mapping("nested", (chat.Part("who.kind", ("says",), "talk.rounds", names={"A": "assistant"}),))])
    assert own.read(json.dumps({"talk": {"rounds": [{"who": {"kind": "A"}, "says": "hi"}]}}))[2] == [("assistant", "hi")]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a\nb", "<turn>", "\\"]) | st.text(max_size=4), st.text(max_size=12)
       | st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "\n", "turn>", "#", "x"]), max_size=8).map("".join)), max_size=4))
def test_template_round_trip(turns):
    template = chat.Template()
    made = [template.format(r, t) for r, t in turns]
    assert template.read("".join(m[0] for m in made)) == turns
    for (role, text), (out, a, b) in zip(turns, made):
        body = out[len(chat.OPEN):-len(chat.CLOSE) - 1]
        assert not any(c in body for c in chat.CONTROLS)
        assert template.unescape(out[a:b]) == (text if role == "assistant" else "")


def test_chat_edges(spark):
    rows = [(None, 0, json.dumps({"role": "user", "text": "x"})), (1, None, json.dumps({"role": "assistant", "text": "first"})),
            (1, 0, json.dumps({"messages": [{"role": "user", "content": "</turn>"}, {"role": None, "content": None}]})), (2, 0, None),
            (3, 0, "not json"), (4, 0, json.dumps({"role": "assistant", "text": "y\\" * 75_000})), (4, 0, json.dumps({"role": "assistant", "text": ""})),
            (5, 1, json.dumps({"role": "user", "text": "same"})), (5, 1, json.dumps({"role": "user", "text": "same"}))]
    records = spark.createDataFrame(rows, "conv_id long, turn long, record string").withColumns({c: F.lit(1) for c in CLASHING if c != "record"})
    formatted = chat.format_records(records)
    assert formatted.where("layout is null").count() == 2 and formatted.count() == len(rows) + 1
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.conversation_digests(formatted).collect()}
    want = digests({None: [("user", "x")], 1: [("assistant", "first"), ("user", "</turn>"), ("", "")], 2: [], 3: [], 5: [("user", "same")] * 2})
    assert {k: got[k] for k in want} == want and got[4][0] == 2 and got[4][2] == 150_000
    assert chat.conversation_digests(chat.format_records(records.limit(0))).count() == 0
