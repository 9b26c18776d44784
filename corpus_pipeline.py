"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the
last return the columns of documents.  ``run`` writes every stage's result to
the shared folder and rereads it for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast.llm import lines, mixing, packing, quality, simhash
from shipcast.llm.common import discard, read, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go."""
    scored = quality.classify(docs, read(spark, sf_dir, "labels"))
    return scored.where(F.col("_q_score") >= quality.THRESHOLD).select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats, or nearly repeats, are cut from the texts."""
    cut = lines.dedup(docs).select(docs.columns)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_first(docs, shingle=4, radius=4)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.training_order(mixing.mix(docs)).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place in it."""
    return packing.pack(docs, capacity=2048)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: The learned classifier has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{k}")
        if k:
            discard(before)
    return docs
