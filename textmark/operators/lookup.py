"""Joins of a large table with a lookup table that has one row per key.

The lookup side is broadcast only after its rows and bytes were counted.  Beyond
the bound both sides are shuffled with a salt, so a key that holds a third of
the large table is spread over many tasks.  A lookup that knows how often its keys
occur needs neither: ``frequent_join`` sends the frequent ones to every task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmark.settings import BROADCAST_BYTES, BROADCAST_ROWS, FREQUENT_BYTES

SALTS = 16


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Count rows and bytes, reading no more than ``max_rows + 1`` rows."""
    size = F.octet_length(F.to_json(F.struct("*")))
    seen = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).first()
    return seen["n"] <= max_rows and (seen["bytes"] or 0) <= max_bytes


def salted_join(
    large: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str,
    row_key: Sequence[str],
    salts: int = SALTS,
) -> DataFrame:
    """Shuffle join in which each key of ``large`` is split ``salts`` ways.

    ``row_key`` names columns that differ between rows of one key.  Each row of
    ``large`` meets exactly one copy of its lookup row, so inner, left, semi and
    anti joins keep their meaning.
    """
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(*row_key), F.lit(salts)))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    copies = copies.withColumn("_salt", F.col("_salt").cast("long"))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str,
    row_key: Sequence[str],
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``large`` joined with its lookup row: broadcast if it fits, else salted."""
    if fits_broadcast(lookup, max_rows):
        return large.join(F.broadcast(lookup), list(on), how)
    return salted_join(large, lookup, on, how, row_key)


def least_frequent(lookup: DataFrame, n: str, max_bytes: int = FREQUENT_BYTES) -> int | None:
    """The count ``n`` from which on rows of ``lookup`` fit ``max_bytes``; None: all fit."""
    sizes = [F.octet_length(name) if kind == "string" else F.lit(8) for name, kind in lookup.dtypes]
    row = reduce(lambda a, b: a + b, sizes, F.lit(32))
    steps = lookup.groupBy(F.floor(F.log2(n) * 4).alias("step")).agg(F.min(n).alias("n"), F.max(n).alias("most"), F.sum(row).alias("bytes"))
    so_far, least = 0, None
    for step in sorted(steps.collect(), key=lambda x: -x["n"]):  # four for every power of two
        so_far += step["bytes"]
        if so_far > max_bytes:
            return step["most"] + 1 if least is None else least
        least = step["n"]
    return None


def frequent_join(large: DataFrame, lookup: DataFrame, on: str, n: str, least: int) -> DataFrame:
    """``large`` with its lookup row, inner; ``n`` counts a key's rows, ``least`` is ``least_frequent``.

    Rows of frequent keys stay where they are.  The others are shuffled by key; no known key
    among them has many.  ``large`` is read twice: written rows.
    """
    often = lookup.where(F.col(n) >= least).drop(n)
    seldom = lookup.where(F.col(n) < least).drop(n)
    rest = large.join(F.broadcast(often.select(on)), on, "left_anti").join(seldom, on)
    return large.join(F.broadcast(often), on).unionByName(rest)
