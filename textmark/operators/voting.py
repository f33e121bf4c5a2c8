"""Plurality vote over predictions in long form, one row per text and member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmark.functions.votes import valid_mark
from textmark.operators.sampling import whole_mark
from textmark.settings import HIGHEST_MARK, LOWEST_MARK


def vote_whole_marks(df: DataFrame, key: str, mark: str = "mark") -> DataFrame:
    """Vote over whole marks 1..10.

    Ten counters per key fold map-side and cross the network once, so a key with
    any number of votes costs one row per task.  Keys whose members all failed
    keep their row, with NULL.  A mark that is no whole one from 1 to 10 is refused:
    it is counted beside the others, and the key that holds one fails the query.
    Such marks are for ``vote``.
    """
    value = F.col(mark)
    marks = list(range(LOWEST_MARK, HIGHEST_MARK + 1))
    strange = F.count_if(valid_mark(value) & ~whole_mark(value)).alias("_strange")
    counted = df.groupBy(key).agg(*[F.count_if(value == m).alias(f"_{m}") for m in marks], strange)
    most = F.greatest(*[F.col(f"_{m}") for m in marks])
    tied = [F.col(f"_{m}") == most for m in marks]
    total = sum((F.when(t, F.lit(float(m))).otherwise(0.0) for t, m in zip(tied, marks)), F.lit(0.0))
    n_tied = sum((t.cast("double") for t in tied), F.lit(0.0))
    refused = F.raise_error(F.concat(F.col("_strange"), F.lit(" marks are not whole ones from 1 to 10")))
    voted = F.when(most > 0, total / n_tied)
    return counted.select(key, F.when(F.col("_strange") > 0, refused.cast("double")).otherwise(voted).alias("mark"))


def vote(df: DataFrame, key: str, mark: str = "mark") -> DataFrame:
    """Vote over marks of any value.

    Three nested aggregates, each combining before its shuffle: votes per mark,
    tied marks per number of votes, the largest number per key.
    """
    given = F.when(valid_mark(F.col(mark)), F.col(mark))
    votes = df.groupBy(key, given.alias("_mark")).agg(F.count(given).alias("_n"))
    ties = votes.groupBy(key, "_n").agg(F.avg("_mark").alias("_mean"))
    return ties.groupBy(key).agg(F.max_by("_mean", "_n").alias("mark"))
