"""Exact positions and first-n without moving a group into one task.

Positions within hash order come from the digest itself: count rows per digest
prefix, add up the counts of the prefixes before, and rank only inside a prefix.
Keys are unique, so the prefixes are of even size whatever group is large.
Positions within any other order come from a distributed sort whose partitions
are pinned by a checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmark.functions.keys import key_digest
from textmark.runtime import cut_lineage
from textmark.settings import TOP_K_ROWS

# Hex digits of the digest that form a bucket: 65,536 buckets per group.
BUCKET_DIGITS = 4


def _with_bucket(df: DataFrame, key: str, salt: str) -> DataFrame:
    return df.withColumn("_digest", key_digest(F.col(key), salt)).withColumn(
        "_bucket", F.substring("_digest", 1, BUCKET_DIGITS)
    )


def bucket_offsets(bucketed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group and bucket: rows in it, rows before it, rows in the group.

    Counting combines map-side.  The window runs over at most 65,536 rows per
    group, however large the data.
    """
    counts = bucketed.groupBy(*by, "_bucket").agg(F.count("*").alias("_in_bucket"))
    group = Window.partitionBy(*by)
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *by,
        "_bucket",
        "_in_bucket",
        F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)).alias("_before"),
        F.sum("_in_bucket").over(group).alias("_in_group"),
    )


def _rank_in_bucket(by: Sequence[str], key: str) -> Column:
    window = Window.partitionBy(*by, "_bucket").orderBy("_digest", key)
    return F.col("_before") + F.row_number().over(window)


def hash_positions(
    df: DataFrame,
    key: str,
    by: Sequence[str] = (),
    salt: str = "",
    name: str = "position",
    total: str | None = None,
) -> DataFrame:
    """Add each row's 1-based position in hash order, within its ``by`` group.

    ``total`` names a further column with the size of the group.
    """
    bucketed = _with_bucket(df, key, salt)
    joined = bucketed.join(bucket_offsets(bucketed, by), [*by, "_bucket"])
    added = [_rank_in_bucket(by, key).cast("long").alias(name)]
    if total is not None:
        added.append(F.col("_in_group").alias(total))
    return joined.select(*df.columns, *added)


def in_hash_order(key: str, salt: str = "") -> Column:
    """What rows are compared by: the digest, then the key itself."""
    return F.struct(key_digest(F.col(key), salt).alias("digest"), F.col(key).alias("key"))


def hash_cutoffs(
    df: DataFrame, key: str, by: Sequence[str], quota: Column, salt: str = ""
) -> DataFrame:
    """Per group, the last row in hash order that is within ``quota`` rows.

    ``quota`` is an expression over ``_in_group``, the size of the group.  Only
    the one bucket of each group in which the quota ends is ranked; every other
    row takes part in nothing but the counting.  One row per group and bucket is
    joined back, by the plan that their number asks for.
    """
    bucketed = _with_bucket(df.select(*by, key), key, salt)
    offsets = bucket_offsets(bucketed, by).withColumn("_quota", F.floor(quota))
    ends = offsets.where(
        (F.col("_before") < F.col("_quota"))
        & (F.col("_quota") <= F.col("_before") + F.col("_in_bucket"))
    )
    ranked = bucketed.join(ends, [*by, "_bucket"]).withColumn(
        "_position", _rank_in_bucket(by, key)
    )
    last = F.struct(F.col("_digest").alias("digest"), F.col(key).alias("key"))
    return ranked.where(F.col("_position") == F.col("_quota")).select(*by, last.alias("_last"))


def row_index(df: DataFrame, order: Sequence[Column | str], name: str = "idx") -> DataFrame:
    """Add a 0-based row number over the whole table in the stated order.

    The range-partitioned sort is written once; afterwards a row's number is its
    place in its partition plus the sizes of the partitions before.  Only those
    sizes, one row per partition, are added up in one task and broadcast.
    Pass narrow rows, since everything in ``df`` is written, and end the order
    with a unique column, so that equal rows do not share one partition.
    """
    pinned = cut_lineage(df.orderBy(*order)).select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_place"),
    )
    sizes = pinned.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    numbered = pinned.join(F.broadcast(starts), "_part")
    return numbered.select(*df.columns, (F.col("_start") + F.col("_place")).alias(name))


def limit_in_order(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows in a total order.

    A small ``n`` is a top-k over all tasks; a large one would gather too much in
    the last of them, so it keeps the rows numbered below ``n`` instead.
    """
    if n <= TOP_K_ROWS:
        return df.orderBy(*order).limit(n)
    return row_index(df, order, "_row").where(F.col("_row") < n).drop("_row")
