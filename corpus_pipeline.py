"""From raw documents to packed sequences: quality, language, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last
return the columns of documents, whatever they are; run() writes each stage's rows to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakespan.llm import decontam, langid, minhash, packing, quality
from lakespan.llm.scratch import Scratch, sweep


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told."""
    return langid.keep_identified(spark, docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and where they stand in sequences."""
    return packing.pack(packing.pieces(docs.select("doc_id", "text")))


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("MinHash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]
#: SQL can express neither the trained models nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        before = len(Scratch.made)
        docs = s.cut(stage(spark, docs, sf_dir), f"stage-{i}")
        sweep(before, s)  # what the stage kept for itself
    return docs
