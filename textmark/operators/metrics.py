"""Error figures over ``(prediction, label)`` rows, one pass each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def accuracy(prediction: str = "prediction", label: str = "label") -> Column:
    """Share of all labelled rows; a row without a prediction is a miss."""
    hit = F.coalesce(F.col(prediction) == F.col(label), F.lit(False)).cast("double")
    return F.avg(F.when(F.col(label).isNotNull(), hit))


def mean_error(prediction: str = "prediction", label: str = "label") -> Column:
    return F.avg(F.abs(F.col(label) - F.col(prediction)))


def max_error(prediction: str = "prediction", label: str = "label") -> Column:
    return F.max(F.abs(F.col(label) - F.col(prediction)))


def auc_of_classes(prediction: str = "prediction", label: str = "label") -> Column:
    """Area under the ROC of hard 0/1 predictions: mean of both hit rates."""
    hit = F.avg(F.when(F.col(label) == 1.0, F.col(prediction)))
    reject = F.avg(F.when(F.col(label) == 0.0, 1.0 - F.col(prediction)))
    return (hit + reject) / 2.0


def error_report(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, mean and largest absolute error, all together or per group."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n"),
        accuracy().alias("accuracy"),
        mean_error().alias("mean_error"),
        max_error().alias("max_error"),
    )


def member_accuracy(df: DataFrame, member: str = "member") -> DataFrame:
    return df.groupBy(member).agg(accuracy().alias("accuracy"))


def mean_member_accuracy(df: DataFrame, member: str = "member") -> DataFrame:
    """Plain mean of the members' accuracies; not the accuracy of their vote."""
    return member_accuracy(df, member).agg(F.avg("accuracy").alias("mean_accuracy"))


def confusion(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count("*").alias("n"))


def stage_counts(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """``(stage, n)``: rows that meet each stage's condition, all in one scan."""
    counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in stages.items()])
    return counted.unpivot([], list(stages), "stage", "n")
