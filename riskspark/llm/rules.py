"""Quality rules: log-likelihood ratios of hashed n-grams, with DataFrame functions only.

Words and pairs of neighbouring words are hashed into ``BUCKETS``. Two multinomials
over the buckets are counted, one over all documents (raw corpus) and one over all
trusted ones; the trusted one is shrunk towards the raw one with
the weight of its own size, so a bucket it never saw counts as half as likely at
worst. A document's score is the mean log ratio of its n-grams.

Log ratios shrink as the corpus fills the buckets, so the place of the cut comes from
the data: the trusted documents are dealt into ``FOLDS`` folds, each is scored by the
multinomial of the other folds (any other document by the mean of these log ratios),
and all scores are moved by one number so that the ``LOW`` quantile of the trusted ones
lies at ``THRESHOLD``. Every document below ``threshold``, or
failing the base rules, is not kept; nothing is drawn at random.

No text is joined to labels for scoring. A document's fold is a hash of its id, so every row is scored
twice where it lies (without its own fold, and by the mean), and only the narrow rows of scores
meet the trusted ids. For the target counts, a bitmap of the ids' hashes (fixed size) leaves
the texts that can be trusted, and these alone are joined to the ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import SPACE, doc_texts, written

BUCKETS = 1 << 17
STEPS = 10_000
THRESHOLD = -0.04
FOLDS = 4
LOW = 0.01
MIN_WORDS = 20
WINDOW = 8
#: Bits of the map of trusted ids (8 MB at most).
ID_BITS = 1 << 26


def with_words(texts: DataFrame) -> DataFrame:
    """``texts`` (doc_id, text and others) and words, the runs between ASCII white space."""
    trimmed = F.btrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    return texts.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>"))
                            .otherwise(F.split(trimmed, SPACE)))


def _with_next(name: str, step: int) -> Column:
    """Hash of every element of a hash array with the one ``step`` places on (null past the end)."""
    return F.transform(name, lambda h, i: F.xxhash64(h, F.get(name, i + step)))


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _fold(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("fold")), F.lit(FOLDS)).cast("int")


def _by_word(rows: DataFrame) -> DataFrame:
    """``rows`` (words and others) with b1 and b2, the buckets of each word and of the pair that it starts, instead of words.

    One row per word, in generated code; b2 is null for the last word, both are null in the one row of a text without words."""
    size = F.size("words")
    others = [c for c in rows.columns if c != "words"]
    pairs = rows.withColumn("after", F.slice("words", F.lit(2), F.greatest(size - 1, F.lit(0))))
    h1, h2 = F.xxhash64("words"), F.xxhash64("after")
    return (pairs.select(*others, F.inline_outer(F.arrays_zip("words", "after")))
            .select(*others, F.when(F.col("words").isNotNull(), _bucket(h1)).alias("b1"),
                    F.when(F.col("after").isNotNull(), _bucket(F.xxhash64(h1, h2))).alias("b2")))


def _trusted_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents in ``ids``.

    A row is first tested against a bitmap of hashed ids (ID_BITS bits, whatever the number of ids), which is
    small enough to send to every task; only rows that pass it meet the ids."""
    def place(doc_id: Column) -> Column:
        return F.pmod(F.xxhash64(doc_id, F.lit("bit")), F.lit(ID_BITS))

    own = place(F.col("doc_id"))
    bits = ids.groupBy(F.bitmap_bucket_number(own).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(own)).alias("bits"))
    at = F.bitmap_bit_position(own)
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    texts = doc_texts(docs).withColumn("part", F.bitmap_bucket_number(own)).join(F.broadcast(bits), "part")
    passed = texts.where(F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1)
    # ids are distinct; a semi join would be pushed below the test and shuffle every text
    return passed.select("doc_id", "text").join(ids.hint("merge"), "doc_id")  # one plan at every size


def _trusted_ids(trusted: DataFrame) -> DataFrame:
    # written, so that their size is known to the joins: the texts are dealt anew only where it is large
    return written(trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct(), "trusted")


def fold_weights(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(bucket, w0, .., all): the log ratio of every bucket in steps of 1 / STEPS, by fold to leave out, and with all folds.

    Raw counts cover all documents, target counts those of ``ids`` (distinct doc_id). BUCKETS rows, written."""
    def counted(texts: DataFrame, *extra: Column) -> DataFrame:
        grams = _by_word(with_words(texts).drop("text")).select("fold", F.explode(F.array("b1", "b2")).alias("bucket"))
        return grams.where("bucket is not null").groupBy("bucket").agg(*extra)

    names = [f"t{k}" for k in range(FOLDS)]
    raw_counts = counted(doc_texts(docs).select(F.lit(0).alias("fold"), "text"), F.count("*").alias("raw"))
    targets = counted(_trusted_texts(docs, ids).select(_fold(F.col("doc_id")).alias("fold"), "text"),
                      *[F.count_if(F.col("fold") == k).alias(t) for k, t in enumerate(names)])
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    counts = written(every.join(raw_counts, "bucket", "left").join(targets, "bucket", "left")
                     .select("bucket", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("raw", *names)]), "buckets")
    total = counts.agg(*[F.sum(c).alias(c) for c in ("raw", *names)]).first()
    raw = (F.col("raw") + 0.5) / F.lit(total.raw + 0.5 * BUCKETS)

    def ratio(used: list[str]) -> Column:
        n = sum(total[t] for t in used)
        prior = max(1, n)
        target = (sum((F.col(t) for t in used), F.lit(0)) + prior * raw) / F.lit(float(n + prior))
        return F.round(F.log(target / raw) * STEPS).cast("int")

    return written(counts.select("bucket", *[ratio([t for t in names if t != out]).alias(f"w{k}") for k, out in enumerate(names)],
                                 ratio(names).alias("all")), "weights")


def bucket_weights(docs: DataFrame, trusted: DataFrame) -> list[int]:
    """The log ratio of every bucket in steps of 1 / STEPS. ``trusted``: doc_id of trusted documents.

    Raw counts cover all documents, target counts all trusted ones; a repeated id counts once."""
    return [r["all"] for r in fold_weights(docs, _trusted_ids(trusted)).orderBy("bucket").collect()]


def _low_score(scored: DataFrame) -> float | None:
    """The LOW quantile of the scores of trusted documents that pass the base rules, in steps of 1 / STEPS."""
    step = F.floor(F.col("score") * STEPS).alias("step")
    # as many rows as there are steps between the scores, whatever the input
    steps = scored.where(F.col("trusted") & ~F.col("base_failed")).groupBy(step).count().orderBy("step").collect()
    left = int(LOW * sum(r["count"] for r in steps))
    for r in steps:
        if left < r["count"]:
            return r["step"] / STEPS
        left -= r["count"]
    return None


def _with_repeats(rows: DataFrame) -> DataFrame:
    """``rows`` (words and others) with n_repeat_words: words inside windows of WINDOW (8) words found twice or more in the text.

    Windows are compared by hash first; only a text that seems to repeat one sorts its
    windows, compares neighbours word by word and counts the words that repeats cover."""
    none = F.array().cast("array<struct<h:bigint,at:int>>")
    # hashes of 1, 2, 4 and 8 words, each from two of the ones before; past the end, of what there is
    out = rows.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    for half in (1, 2, 4):
        out = out.withColumn(f"h{2 * half}", _with_next(f"h{half}", half))
    out = (out.withColumn("h8", F.slice("h8", F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(0)))).drop("h1", "h2", "h4")
           .withColumn("ordered", F.when(F.size(F.array_distinct("h8")) < F.size("h8"), F.sort_array(F.transform(
               "h8", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))).otherwise(none)).drop("h8"))

    def same(a: Column, b: Column) -> Column:
        def words(x: Column) -> Column:
            return F.slice("words", x["at"] + 1, F.lit(WINDOW))

        return F.coalesce((a["h"] == b["h"]) & (words(a) == words(b)), F.lit(False))

    size = F.size("ordered")
    out = out.withColumn("like_next", F.zip_with("ordered", F.slice("ordered", F.lit(2), size), same))
    like_before = F.concat(F.array(F.lit(False)), F.slice("like_next", F.lit(1), F.greatest(size - 1, F.lit(0))))
    out = out.withColumn("places", F.sort_array(F.transform(F.filter(F.zip_with(
        "ordered", F.zip_with("like_next", like_before, lambda a, b: a | F.coalesce(b, F.lit(False))),
        lambda x, repeated: F.struct(x["at"].alias("at"), repeated.alias("repeated"))),
        lambda x: x["repeated"]), lambda x: x["at"])))
    covered = F.aggregate("places", F.struct(F.lit(0).alias("until"), F.lit(0).alias("n")), lambda s, i: F.struct(
        (i + WINDOW).alias("until"), (s["n"] + i + WINDOW - F.greatest(s["until"], i)).alias("n")), lambda s: s["n"])
    return out.withColumn("n_repeat_words", covered.cast("long")).drop("ordered", "like_next", "places")


def apply_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score).

    One row for every row of ``docs``. Null and empty texts have no words: all counts are
    0 and the base rules reject them; their mean log ratio is 0. A trusted document is
    scored by the other folds, any other one by the mean over them. Scores are moved so that the LOW quantile of trusted
    documents lies at THRESHOLD (not at all if none passes the base rules). Without trusted
    documents every score is 0 and the base rules alone decide. Rows are judged on their own, so null and
    repeated ids need no care; an empty table gives no rows; further columns are ignored.
    """
    ids = _trusted_ids(trusted)
    folds = [f"w{k}" for k in range(FOLDS)]
    weights = fold_weights(docs, ids)
    # halves to even, as a mean of integers is rounded in Python
    weights = weights.select("bucket", *folds, F.bround(sum(F.col(w) for w in folds) / FOLDS).cast("int").alias("mean"))
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    rows = _with_repeats(with_words(doc_texts(docs))).withColumn("lines", lines)
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", _fold(F.col("doc_id")).alias("own"), "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words")

    def of(n: int) -> tuple[DataFrame, Column]:
        """(weights by bucket b<n>, the weight that leaves out the row's own fold); BUCKETS rows, whatever the input."""
        named = weights.select(F.col("bucket").alias(f"b{n}"), *[F.col(w).alias(f"{w}_{n}") for w in (*folds, "mean")])
        chosen = F.col(f"w{FOLDS - 1}_{n}")
        for k in range(FOLDS - 1):
            chosen = F.when(F.col("own") == k, F.col(f"w{k}_{n}")).otherwise(chosen)
        return F.broadcast(named), F.coalesce(chosen, F.lit(0)).cast("long")

    (first, own1), (second, own2) = of(1), of(2)
    mean = sum(F.coalesce(f"mean_{n}", F.lit(0)).cast("long") for n in (1, 2))
    words = _by_word(rows).join(first, "b1", "left").join(second, "b2", "left")
    summed = written(words.groupBy("row", "doc_id", *measures).agg(F.sum(own1 + own2).alias("left_out"), F.sum(mean).alias("mean")), "rule-sums")
    # integer sums do not depend on their order; a word is one gram, and all but the last start a pair
    grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    marked = summed.join(ids.withColumn("trusted", F.lit(True)).hint("merge"), "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    scored = marked.withColumn("score", F.when(F.col("trusted"), F.col("left_out")).otherwise(F.col("mean")) / (grams * STEPS))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scored = written(scored.select("doc_id", "trusted", *measures, "score", failed.alias("base_failed")), "rule-scores")
    low = _low_score(scored)
    moved = F.col("score") - F.lit(0.0 if low is None else low - THRESHOLD)
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & (moved >= threshold)).alias("kept"), moved.alias("score"))


def trusted_documents(labels: DataFrame) -> DataFrame:
    """doc_id of the documents marked as good."""
    return labels.where(F.col("quality") == 1).select("doc_id")
