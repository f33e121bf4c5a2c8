"""From raw documents to packed sequences; each stage is one operator of ``textmark.llm``.

Every stage takes ``(spark, docs, folder)`` and works on all rows that the one before it
kept.  All but the last return the columns of ``docs``.

Defined results: empty tables give empty tables; null and empty texts are scored like any
other and, where kept, stay; rows whose ``doc_id`` is null belong to no group of near
duplicates and stay; of rows that repeat the ``doc_id`` of a group's representative, one
stays; extra columns are carried along unread.  Every stage bounds the session's Arrow
batches by ``settings.BATCH_BYTES``, and they stay so bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmark.llm import decontaminate, jaccard, pii, quality
from textmark.llm.frames import narrowed, small_batches, stored, without
from textmark.llm.queries import packed, quality_model, table


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts that the quality classifier accepts."""
    small_batches(spark)
    score = quality.scorer(quality_model(spark, folder))
    return docs.where(quality.accepted(score("text")))


def one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    small_batches(spark)
    groups = stored(jaccard.near_duplicates(docs).where("doc_id is not null"), "pipeline-groups")
    copies = groups.where("doc_id <> component_id").select("doc_id").distinct()
    repeated = groups.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1")
    repeated = repeated.select("doc_id")
    # Representatives whose id is repeated are rare: only their texts are compared by id.
    once = without(docs, copies.union(repeated), ["doc_id"])
    first = narrowed(docs, repeated, ["doc_id"]).dropDuplicates(["doc_id"])
    return once.select(*docs.columns).unionByName(first.select(*docs.columns))


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    small_batches(spark)
    found = decontaminate.contamination(table(spark, folder, "benchmark"))
    return docs.where(~decontaminate.contaminated(found(F.col("text"))))


def without_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts with each span of personal data replaced by its kind."""
    small_batches(spark)
    return docs.withColumn("text", pii.redact(F.col("text"))).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Where each piece of each document stands in the packed sequences."""
    small_batches(spark)
    return packed(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", clean_of_benchmarks),
    ("pii", without_personal_data),
    ("packing", sequences),
]

#: The classifier and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
