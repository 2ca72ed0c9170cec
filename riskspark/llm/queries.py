"""Registered queries of the document and embedding operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import bpe, chat, embed, langid, packing, quality, rules, search, secrets, simhash, suffix, toxicity, trie
from riskspark.llm.common import table
from riskspark.llm.oracle import ORACLE_SQL  # noqa: F401  (read by the entry module)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.deduplicate(table(spark, sf_dir, "documents"), length=100)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents"), rules.trusted_documents(table(spark, sf_dir, "labels")))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_documents(table(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op10_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    import public_tokenizers

    return bpe.round_trip_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(vocabulary))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = search.build_index(table(spark, sf_dir, "documents"))
    return search.search(index, table(spark, sf_dir, "benchmark"), k=20)


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = chat.collected_records(table(spark, sf_dir, "conversations")).unionByName(chat.quoting_record(spark))
    return chat.conversation_digests(chat.format_records(records))


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_toxicity, op3_best_fit_packing, op4_secret_scan, op5_suffix_dedup, op6_quality_rules,
                                  op7_simhash_near_dedup, op8_language_id, op9_embedding_near_dedup,
                                  op10_bpe, op11_conversation_trie, op12_lexical_search, op13_chat_format)}
