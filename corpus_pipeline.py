"""A training corpus from ``documents`` in stages, each one an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm import bagminhash, decontam, mixing, quality, sharding
from flightlake.llm.common import materialise, table
from flightlake.session import drop_stored, stored_tables


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 1").select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return bagminhash.drop_near_duplicates(docs, null_ids_stay=False)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document comes as often as the mix takes it."""
    return mixing.repeat_taken(mixing.mix_sources(docs)).select(docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus in 40 contiguous shards of near-equal bytes, by id, then text."""
    ordered = docs.withColumn("__text", F.md5("text"))
    return sharding.shard_documents(ordered, 40, order=["doc_id", "__text"]).drop("__text")


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", drop_copies),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]

#: Trained stages cannot be told in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each result is written and
    reread, and what a stage wrote on its way is removed when its result stands."""
    docs = table(spark, sf_dir, "documents")
    before = set(stored_tables())
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"stage{i}")
            result = stored_tables()[-1]
            drop_stored(spark, [t for t in stored_tables() if t not in before and t != result])
    return docs
