"""Sample texts, one per file, the mark in the path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_sample_files(
    spark: SparkSession, path: str, mark_pattern: str = r"_(\d+)\.txt$"
) -> DataFrame:
    """``(mark, text)``: each file is one row, however many lines it has."""
    files = spark.read.text(path, wholetext=True)
    mark = F.regexp_extract(F.col("_metadata.file_path"), mark_pattern, 1)
    return files.select(mark.try_cast("int").alias("mark"), F.col("value").alias("text"))
