"""The corpus pipeline: stages over ``documents``, each written and reread.

Quality rules, near-duplicate removal, benchmark decontamination and source
mixing filter the documents and keep their columns; sharding ends with one
manifest row per document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import decontamination, mixing, quality_rules, sharding, simhash
from shelfline.llm.common import carried, stored, table


def _whole(docs: DataFrame, *names: str) -> DataFrame:
    """The columns ``names`` and the whole row as one column ``doc_``, out
    of reach of the names that an operator adds."""
    return docs.select(F.struct(*carried(docs, [])).alias("doc_"), *names)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ids, n = quality_rules.trusted_documents(spark, sf_dir)
    return quality_rules.quality(_whole(docs, "doc_id", "text"), ids, n).where("kept").select("doc_.*")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.deduplicate(docs, size=3, max_bits=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken by the mix, once each (one epoch)."""
    whole = _whole(docs, "doc_id", "text", "lang", "source")
    return mixing.mix(whole, max_epochs=1).select("doc_.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The manifest of the shards."""
    return sharding.shard_manifest(docs, n_shards=16)


STAGES = [("quality_rules", quality_stage), ("simhash", simhash_stage),
          ("decontamination", decontamination_stage), ("mixing", mixing_stage),
          ("sharding", sharding_stage)]

# XXH64 and the edit distance to a substring are not in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
