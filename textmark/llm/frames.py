"""Written tables that cut lineage, and connected components over them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmark.operators.lookup import fits_broadcast
from textmark.runtime import work_folder
from textmark.settings import BATCH_BYTES


def small_batches(spark: SparkSession) -> None:
    """From now on an Arrow batch of ``spark`` takes no further row beyond ``BATCH_BYTES``.

    By itself Spark allows 64 MB, so a whole split of long texts becomes one batch, and each
    task holds it several times, beside the JVM's heap and in Python.  All rows are still
    read, in more batches.  A smaller bound that the session has already stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(name).strip().lower())
    most = int(given[1]) << 10 * " kmgtp".index(given[2] or " ") if given else 0
    if not 0 < most <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Later steps start from the files, whichever executors are lost meanwhile.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def narrowed(large: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``large`` joined with ``keys``, which are distinct.

    Keys are broadcast after their size was checked; more of them take a shuffle.
    """
    return large.join(F.broadcast(keys) if fits_broadcast(keys) else keys, on)


def without(large: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``large`` whose key is not among ``keys``; null keys stay."""
    return large.join(F.broadcast(keys) if fits_broadcast(keys) else keys, on, "left_anti")


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``, root being the smallest reachable.

    Alternating stars: every node hands its smallest neighbour to its larger ones, then to
    its smaller ones, until no edge changes.  Minima are pre-aggregated before the shuffle,
    so a node with very many neighbours costs one row per task.
    """
    spark = edges.sparkSession
    edges = edges.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = stored(edges.distinct(), purpose)
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.where("u != v").union(least.select("u", "m")).distinct(), purpose)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
