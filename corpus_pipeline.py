"""The corpus pipeline: stages that each read what the one before wrote.

Every stage takes all documents that came to it and returns the columns of documents; the last adds its shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.llm import decontaminate, jaccard_join, language_id, mixing, sharding
from msgflow.llm.common import identity, stored, table

#: A document whose best language is less likely than this is in none of them.
LEAST_SCORE = 0.4


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without a letter or with no clear language go."""
    model = language_id.train(docs, label=F.col("lang"), learn=F.lit(True))
    boxed = docs.select("text", F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    judged = language_id.predict(boxed, model, keep=["row"])
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return judged.where(known).select("row.*")


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of every group of linked documents; a repeated row once.

    Documents of one id with different texts are different documents. Those without an id have no links.
    """
    numbered = docs.dropDuplicates(["doc_id", "text"]).withColumn("_node", F.monotonically_increasing_id())
    once = stored(numbered, "numbered")
    node = F.when(F.col("doc_id").isNotNull(), F.col("_node"))
    groups = jaccard_join.linked(once.select(node.alias("doc_id"), "text"))
    members = groups.select(F.col("doc_id").alias("_node"), "component_id").where(F.col("_node").isNotNull())
    rank = F.struct("doc_id", identity(F.col("doc_id"), F.col("text")), "_node").alias("_rank")
    ranked = members.join(once.select("_node", rank), "_node")
    least = ranked.groupBy("component_id").agg(F.min("_rank").alias("_least"))
    kept = least.select(F.col("_least._node").alias("_node"))
    chosen = once.where(F.col("doc_id").isNotNull()).join(kept, "_node", "left_semi")
    return chosen.union(once.where(F.col("doc_id").isNull()).select(*chosen.columns)).select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs, weights=(5, 2, 1), share=(3, 2), max_epochs=2)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot along the curve."""
    dimensions = {"lang": F.col("lang"), "source": F.col("source"), "n_chars": F.col("n_chars")}
    return sharding.hilbert_shards(docs, dimensions, shards=24, keep=docs.columns)


STAGES = [
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing to target weights", mixing_stage),
    ("Hilbert sharding", sharding_stage),
]

#: The network and the set join can't be said in SQL; a test holds the near-copy stage against a plain version. The other
#: stages and ``run`` have no test of their own rows, only of the operators they call.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
