"""Plurality vote over an array of marks, row by row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmark.settings import FAILED_MARK


def valid_mark(mark: Column) -> Column:
    """False for a failed member: no mark, or the failure marker."""
    return mark.isNotNull() & (mark != F.lit(FAILED_MARK))


def plurality(marks: Column) -> Column:
    """The mark given most often; the mean of the tied marks on a tie.

    NULL when no member gave a mark.  Meant for one mark per ensemble member,
    so the array is as short as the ensemble.
    """
    given = F.filter(marks, valid_mark)
    counted = F.transform(
        F.array_distinct(given),
        lambda mark: F.struct(
            F.size(F.filter(given, lambda other: other == mark)).alias("n"),
            mark.alias("mark"),
        ),
    )
    most = F.array_max(F.transform(counted, lambda c: c["n"]))
    tied = F.transform(F.filter(counted, lambda c: c["n"] == most), lambda c: c["mark"])
    total = F.aggregate(tied, F.lit(0.0), lambda sum_, mark: sum_ + mark)
    return F.when(F.size(given) > 0, F.try_divide(total, F.size(tied).cast("double")))
