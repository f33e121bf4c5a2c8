"""Bounded, repeatable samples of labelled rows for the classifiers that are trained here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmark.llm.frames import narrowed


def fold(key: str | Column, folds: int) -> Column:
    """``crc32`` of the key as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")), F.lit(folds))


def sampled(rows: DataFrame, key: str, label: str, per_label: int) -> DataFrame:
    """``(key, label)`` of at most ``per_label`` keys of each label, chosen by hash.

    Labels are counted first; of a label with many rows only about the wanted share, by
    hash, is ranked, so a label of very many rows never meets in one task.  Null keys and
    labels are left out; a repeated key counts once.
    """
    rows = rows.select(F.col(key).alias("key"), F.col(label).alias("label")).dropna().distinct()
    counts = rows.groupBy("label").agg(F.count("*").alias("rows"))
    share = F.pmod(F.xxhash64(F.lit("sample"), "key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = narrowed(rows, counts, ["label"]).where(share * F.col("rows") <= 1.2 * per_label + 50)
    order = Window.partitionBy("label").orderBy(F.xxhash64("key"), "key")
    rows = rows.withColumn("rank", F.row_number().over(order))
    return rows.where(F.col("rank") <= per_label).select("key", "label")
