"""Cleaning, relabelling, splitting and balancing of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmark.functions.keys import in_share, key_digest
from textmark.functions.votes import valid_mark
from textmark.operators.lookup import fits_broadcast
from textmark.operators.ranking import hash_cutoffs, hash_positions, in_hash_order, row_index
from textmark.runtime import written
from textmark.settings import HIGHEST_MARK, LOWEST_MARK, SHUFFLE_SEED, TRAIN_SHARE


def drop_incomplete(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every named column has a value; the filter reaches the scan."""
    return df.dropna(subset=list(columns))


def to_class_index(df: DataFrame, mark: str = "rating", label: str = "label") -> DataFrame:
    """Marks 1..10 to class indices 0..9."""
    return df.withColumn(label, F.col(mark).cast("double") - LOWEST_MARK)


def to_mark(df: DataFrame, label: str = "prediction", mark: str = "mark") -> DataFrame:
    """Class indices back to marks."""
    return df.withColumn(mark, F.col(label).cast("double") + LOWEST_MARK)


def whole_mark(value: Column) -> Column:
    """True for a whole number from 1 to 10."""
    return value.between(LOWEST_MARK, HIGHEST_MARK) & (value == F.floor(value))


def valid_marks(df: DataFrame, mark: str = "rating") -> DataFrame:
    return df.where(whole_mark(F.col(mark)))


def drop_failed(df: DataFrame, mark: str = "mark") -> DataFrame:
    """Rows of members that gave a mark."""
    return df.where(valid_mark(F.col(mark)))


def binarise(df: DataFrame, target: float, mark: str = "rating", label: str = "label") -> DataFrame:
    """1.0 for the target mark, 0.0 for every other."""
    return df.withColumn(label, (F.col(mark) == F.lit(target)).cast("double"))


def split(
    df: DataFrame, key: str, salt: str = "", share: float = TRAIN_SHARE
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, chosen by the key alone: no shuffle, repeatable."""
    chosen = in_share(F.col(key), share, salt)
    return df.where(chosen), df.where(~chosen)


def random_split(
    df: DataFrame, seed: int | None = None, share: float = TRAIN_SHARE
) -> tuple[DataFrame, DataFrame]:
    """Spark's own row-wise split; depends on partitioning, unlike ``split``."""
    train, test = df.randomSplit([share, 1.0 - share], seed)
    return train, test


def stratified_split(
    df: DataFrame, key: str, label: str = "label", salt: str = "", share: float = TRAIN_SHARE
) -> DataFrame:
    """Add ``in_train``: exactly the first ``share`` of every class in hash order.

    Rows are compared with their class's cutoff where they are; none moves unless the
    classes are too many to broadcast.
    """
    cutoffs = hash_cutoffs(df, key, [label], F.col("_in_group") * F.lit(share), salt)
    joined = df.join(_small(cutoffs), label, "left")
    chosen = F.coalesce(in_hash_order(key, salt) <= F.col("_last"), F.lit(False))
    return joined.select(*df.columns, chosen.alias("in_train"))


def _small(cutoffs: DataFrame) -> DataFrame:
    """The cutoffs, computed once, and marked for broadcast if they fit."""
    cutoffs = written(cutoffs, "cutoffs")
    return F.broadcast(cutoffs) if fits_broadcast(cutoffs) else cutoffs


def balance(df: DataFrame, key: str, label: str = "label", salt: str = "") -> DataFrame:
    """As many rows of every class as the smallest class has, first in hash order."""
    least = smallest_class(df, label).first()["n"]
    cutoffs = hash_cutoffs(df, key, [label], F.lit(least or 0), salt)
    joined = df.join(_small(cutoffs), label)
    return joined.where(in_hash_order(key, salt) <= F.col("_last")).select(*df.columns)


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def seeded_order(df: DataFrame, key: str, salt: str = str(SHUFFLE_SEED)) -> DataFrame:
    """The rows in a random but repeatable order (a range-partitioned sort)."""
    return df.orderBy(key_digest(F.col(key), salt), key)


def shuffle_positions(df: DataFrame, key: str, salt: str = str(SHUFFLE_SEED)) -> DataFrame:
    """Add every row's position in ``seeded_order``."""
    return hash_positions(df, key, (), salt)


def union_labelled(*parts: DataFrame) -> DataFrame:
    """All rows of the parts; columns meet by name."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def pair_by_position(
    left: DataFrame, right: DataFrame, left_order: list, right_order: list
) -> DataFrame:
    """Row i of one table beside row i of the other; surplus rows drop.

    Use it only when two tables truly share an order and no key.
    """
    return row_index(left, left_order).join(row_index(right, right_order), "idx")


def smallest_class(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: the size of the smallest class."""
    return class_counts(df, label).agg(F.min("n").alias("n"))
