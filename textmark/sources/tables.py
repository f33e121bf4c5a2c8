"""Parquet tables and the labelled views the bundled queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmark.runtime import spread

# The languages that stand in for marks 1, 2, 3, 4.
LANGUAGE_MARKS = ("de", "en", "es", "fr")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Texts; the wide column makes it worth using every core."""
    chosen = columns or ("doc_id", "text")
    return spread(table(spark, folder, "documents").select(*chosen), "doc_id")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "pages"), "page_id")


def language_rated(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, rating, text)`` with a mark per language."""
    marks = F.array(*[F.lit(name) for name in LANGUAGE_MARKS])
    rating = F.nullif(F.array_position(marks, F.col("lang")), F.lit(0)).cast("double")
    return documents(spark, folder, "doc_id", "lang", "text").select(
        "doc_id", rating.alias("rating"), "text"
    )


def quality_rated(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, rating, text)`` of the documents with a quality label."""
    labels = table(spark, folder, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("rating")
    )
    return documents(spark, folder).join(labels, "doc_id")


def event_results(spark: SparkSession, folder: str) -> DataFrame:
    """Events as scored rows: ``(event_id, user_id, member, prediction, label)``."""
    value = F.floor("value")
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        F.col("event_type").alias("member"),
        (F.pmod(value, F.lit(10)) + 1).cast("double").alias("prediction"),
        (F.pmod("event_id", F.lit(10)) + 1).cast("double").alias("label"),
    )


def embedding_marks(spark: SparkSession, folder: str) -> DataFrame:
    """``(vec_id, rating 1..10, features)``."""
    from pyspark.ml.functions import array_to_vector

    return table(spark, folder, "embeddings").select(
        "vec_id",
        (F.col("label") + 1).cast("double").alias("rating"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )
