"""A corpus pipeline: five operators of ``tidemark.llm``, one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and the next stage reads it from there. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, near_dup, pieces, pii, quality
from tidemark.llm.common import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects. Null and empty texts are rejected."""
    return quality.filter_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8): the one
    with the smallest doc_id. Repeated rows of a doc_id become one, the
    smallest by all columns in their order, so that a task that runs again
    keeps the same; rows without a doc_id, which can't be named, stay."""
    kept = near_dup.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "doc_id"]
    named = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("row"))
    return named.select("doc_id", "row.*").select(*docs.columns).union(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents made of them by half go."""
    return decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and revealing terms are replaced by their kind."""
    return pii.sanitise(docs)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``piece_ids`` beside the columns of ``documents``."""
    return pieces.encode(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sentence_pieces", sentence_pieces),
]

#: SQL can't sample segmentations; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
