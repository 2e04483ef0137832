"""From raw documents to packed training sequences, in five stages.

Each stage takes all documents that the one before it kept and returns documents with the same columns; the last one
returns the packed pieces. ``n_chars`` follows the text wherever a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnloom.llm import language_id, line_dedup, near_dup, packing, pii
from turnloom.llm._common import document_key, with_checkpoints


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or farther from every language than its own documents lie, go."""
    return language_id.accepted(docs, *language_id.learn_profiles_and_limits(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least five documents share stay in the last of them only."""
    return _counted(line_dedup.without_shared_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the first; of rows that repeat its id, one."""
    classes = near_dup.near_duplicate_classes(docs)
    rows = docs.select(document_key().alias("key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    firsts = rows.join(classes, "key", "left").where(F.coalesce("class_id", "key") == F.col("key"))
    placed = firsts.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy("row.text")))
    return placed.where("place = 1").select(*(F.col(f"row.`{c}`") for c in docs.columns))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by their kind in brackets."""
    return _counted(pii.redacted(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document and the bin it lies in."""
    return packing.pack_documents(docs)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("packed", packed)]

#: Language profiles, signatures, boosted trees and packing are no SQL; a test holds each stage against a plain model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what a stage keeps is checkpointed before the next one reads it."""
    with_checkpoints(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).checkpoint()
    return STAGES[-1][1](spark, docs, sf_dir)
