"""Registered queries of the training-data operators over the test tables.

Each runs one operator with production parameters over its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, classifier, conversation_repair, decontamination, fill_middle, line_dedup, lm_scoring, mixing
from . import quality_rules, sharding, simhash, suffix_dedup, token_count
from .common import table


def op1_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontamination.find_items(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op2_token_counts(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers
    return token_count.token_counts(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    ids, n = quality_rules.trusted_documents(spark, d)
    return quality_rules.quality(table(spark, d, "documents"), ids, n).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "mean_log_ratio", "kept")


def op4_simhash(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, d, "documents"), size=3, max_bits=3)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op5_chat_format(spark: SparkSession, d: str) -> DataFrame:
    conv = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)], conv.schema)
    return chat.read_back(chat.expand_examples(conv.unionByName(probe)))


def op6_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, d, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_classifier(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    return classifier.classify(table(spark, d, "documents"), labels)


def op8_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers
    return lm_scoring.score_documents(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard_manifest(table(spark, d, "documents"), n_shards=16)


def op10_mixing(spark: SparkSession, d: str) -> DataFrame:
    mixed = mixing.mix(table(spark, d, "documents"))
    return mixed.select("doc_id", "domain", "lang", "source", "n_tokens", "leaf_budget", "epoch")


def op11_fill_middle(spark: SparkSession, d: str) -> DataFrame:
    return fill_middle.digests(table(spark, d, "documents"))


def op12_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    return conversation_repair.digests(table(spark, d, "conversations"))


def op13_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return line_dedup.deduplicate(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_token_counts, op3_quality_rules, op4_simhash, op5_chat_format, op6_suffix_dedup,
    op7_classifier, op8_lm_scoring, op9_sharding, op10_mixing, op11_fill_middle, op12_conversation_repair,
    op13_line_dedup)}

ORACLES = {"op5_chat_format": chat.ORACLE_SQL, "op9_sharding": sharding.ORACLE_SQL,
           "op10_mixing": mixing.ORACLE_SQL, "op11_fill_middle": fill_middle.ORACLE_SQL,
           "op13_line_dedup": line_dedup.ORACLE_SQL}
