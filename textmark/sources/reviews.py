"""Review and result files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmark.functions.text import parsed_rating
from textmark.sources.records import read_fields

REVIEW_COLUMNS = ("rating", "text")
RESULT_COLUMNS = ("prediction", "label")


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of one line a record with a header; columns by name, quotes in a text doubled.

    Files whose header differs from the first one's are an error, not shifted
    columns; only an index column without a name cannot be checked.
    """

    def read(check_headers: bool) -> DataFrame:
        return spark.read.csv(
            path,
            header=True,
            escape='"',
            enforceSchema=not check_headers,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )

    checked = read(check_headers=True)
    unnamed = any(re.fullmatch(r"_c\d+", name) for name in checked.columns)
    return read(check_headers=False) if unnamed else checked


def read_reviews(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``(rating, text)`` and any other column, such as a key, as a string.

    A rating that is no number is NULL.  Large files are read by many tasks, line breaks
    inside quotes or not; ``multi_line=False`` saves the cutting of records when no text
    holds a line break.
    """
    raw = _reviews(spark, path) if multi_line else _with_review_columns(_read(spark, path), path)
    raw = raw.drop("_record", "_broken")
    others = [name for name in raw.columns if name not in REVIEW_COLUMNS]
    return raw.select(*others, parsed_rating(F.col("rating")).alias("rating"), "text")


def rejects(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> DataFrame:
    """``(record, wrong_fields, no_rating, no_text)``: the records not to be used, as they stand.

    A record that has more or fewer fields than the header is one, whatever it holds.  Files without
    a header need the ``names`` of their columns.
    """
    raw = _reviews(spark, path, names)
    marked = raw.select(
        F.col("_record").alias("record"),
        F.col("_broken").alias("wrong_fields"),
        parsed_rating(F.col("rating")).isNull().alias("no_rating"),
        F.col("text").isNull().alias("no_text"),
    )
    return marked.where("wrong_fields or no_rating or no_text")


def _with_review_columns(raw: DataFrame, path: str) -> DataFrame:
    missing = [name for name in REVIEW_COLUMNS if name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: no column {missing} in header {raw.columns}")
    return raw


def _reviews(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> DataFrame:
    return _with_review_columns(read_fields(spark, path, names), path)


def read_positional(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """First column as rating, second as text, whatever the header says."""
    return spark.read.csv(
        path, schema="rating double, text string", header=True, escape='"', multiLine=multi_line
    )


def with_key(reviews: DataFrame, key: str = "doc_id") -> DataFrame:
    """Name reviews that come without a key by what they hold.

    The key is a hash of the row and of its number among equal rows, so it is the same
    however the rows are partitioned.  Equal rows are counted map-side and told apart
    afterwards; they never meet in one task.
    """
    columns = reviews.columns
    counted = reviews.groupBy(*columns).agg(F.count("*").alias("_n"))
    numbered = counted.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_nth"))
    # Nulls leave a hash unchanged, so each column says whether it holds one.
    content = [x for name in columns for x in (F.col(name).isNull(), F.col(name))]
    return numbered.withColumn(key, F.xxhash64(*content, "_nth")).drop("_nth")


def rejected(reviews: DataFrame) -> DataFrame:
    """How many rows lack a rating, a text, or either."""
    no_rating, no_text = F.col("rating").isNull(), F.col("text").isNull()
    return reviews.agg(
        F.count("*").alias("n_rows"),
        F.count_if(no_rating).alias("no_rating"),
        F.count_if(no_text).alias("no_text"),
        F.count_if(no_rating | no_text).alias("n_rejected"),
    )


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """``(prediction, label)`` as doubles, further columns as strings."""
    raw = _read(spark, path)
    others = [name for name in raw.columns if name not in RESULT_COLUMNS]
    return raw.select(*others, *[F.col(name).try_cast("double") for name in RESULT_COLUMNS])


def write_csv(df: DataFrame, path: str) -> None:
    """One file per partition, quotes doubled, blanks and line breaks kept."""
    df.write.mode("overwrite").csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
