"""Members that fail on single rows lose those votes and no other.

Every member gives a mark and an error, one of them NULL.  ``quarantine`` lists the errors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmark import settings
from textmark.functions.votes import plurality
from textmark.plans.learners import TrainedMember


@dataclass(frozen=True)
class Rater:
    """A member of the user's own: marks of texts, a pandas series from another.

    ``rate`` may raise, and then must not have changed anything: it is called again with
    parts of its batch until the rows that make it raise stand alone.
    """

    name: str
    rate: Callable[[pd.Series], pd.Series]


def _mark_column(name: str) -> str:
    return f"mark_{name}"


def error_column(name: str) -> str:
    return f"error_{name}"


def rated(rate: Callable[[pd.Series], pd.Series], texts: pd.Series) -> pd.DataFrame:
    """``mark`` and ``error`` of every text.

    Each failing row costs one call per halving, so a batch without failures costs one
    call and one of n rows at most 2n - 1.  A result that is no mark is an error too.
    """
    marks, errors = np.full(len(texts), np.nan), np.full(len(texts), None, dtype=object)
    open_parts = [(0, len(texts))] if len(texts) else []
    while open_parts:
        low, high = open_parts.pop()
        try:
            given = np.asarray(rate(texts.iloc[low:high]), dtype="float64")
            if given.shape != (high - low,):
                raise ValueError(f"{given.size} marks for {high - low} texts")
        except Exception as error:
            if high - low == 1:
                errors[low] = f"{type(error).__name__}: {error}"
            else:
                middle = (low + high) // 2
                open_parts += [(low, middle), (middle, high)]
            continue
        usable = (given >= settings.LOWEST_MARK) & (given <= settings.HIGHEST_MARK)
        marks[low:high] = np.where(usable, given, np.nan)
        errors[low:high] = [None if ok else f"no mark: {mark}" for ok, mark in zip(usable, given, strict=True)]
    return pd.DataFrame({"mark": pd.Series(marks).astype(object).where(~np.isnan(marks), None), "error": errors})


def with_raters(df: DataFrame, raters: Sequence[Rater], text: str = "text") -> DataFrame:
    """``df`` with ``mark_<name>`` and ``error_<name>`` of every rater, in one pass over the texts."""
    _different([rater.name for rater in raters])
    rates = [rater.rate for rater in raters]
    fields = ", ".join(f"m{i} double, e{i} string" for i in range(len(raters)))

    @F.pandas_udf(fields)
    def all_rated(texts: pd.Series) -> pd.DataFrame:
        found = [rated(rate, texts).set_axis([f"m{i}", f"e{i}"], axis=1) for i, rate in enumerate(rates)]
        return pd.concat(found, axis=1)

    marked = df.withColumn("_rated", all_rated(F.col(text)))
    columns = {}
    for i, rater in enumerate(raters):
        columns[_mark_column(rater.name)] = F.col("_rated")[f"m{i}"]
        columns[error_column(rater.name)] = F.col("_rated")[f"e{i}"]
    return marked.withColumns(columns).drop("_rated")


def _width(model: PipelineModel) -> int:
    for stage in reversed(model.stages):
        if hasattr(stage, "numFeatures"):
            return stage.numFeatures
        if hasattr(stage, "models"):
            return stage.models[0].numFeatures
    raise ValueError("no classifier in the model")


def vector_error(features: str, width: int) -> Column:
    """What keeps a model of this width from marking a vector, NULL if nothing does."""
    inner = F.unwrap_udt(features)
    length = F.coalesce(inner["size"], F.size(inner["values"]))
    infinite = F.exists(inner["values"], lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (
        F.when(F.col(features).isNull(), F.lit("no vector"))
        .when(length != width, F.concat(F.lit("width "), length.cast("string"), F.lit(f", not {width}")))
        .when(infinite, F.lit("a value is not finite"))
    )


def with_guarded_members(df: DataFrame, members: Sequence[TrainedMember]) -> DataFrame:
    """``mark_<member>`` and ``error_<member>``; a vector that a model cannot take is an error.

    The model is given an empty vector in its place, so that no task fails, and that mark
    is dropped.
    """
    _different([member.spec.member for member in members])
    spark, marked = df.sparkSession, df
    for member in members:
        name, width = member.spec.member, _width(member.model)
        nothing = spark.createDataFrame([(Vectors.sparse(width, {}),)], ["_nothing"])
        safe = F.when(F.col("_error").isNull(), F.col(member.features)).otherwise(F.col("_nothing"))
        guarded = marked.withColumn("_error", vector_error(member.features, width)).crossJoin(F.broadcast(nothing))
        guarded = member.mark(guarded.withColumn("_kept", F.col(member.features)).withColumn(member.features, safe))
        mark = F.when(F.col("_error").isNull(), F.col(_mark_column(name)))
        marked = guarded.withColumns(
            {member.features: F.col("_kept"), _mark_column(name): mark, error_column(name): F.col("_error")}
        ).drop("_kept", "_nothing", "_error")
    return marked


def vote_of(marked: DataFrame, names: Sequence[str]) -> DataFrame:
    """``mark`` by plurality of the members that gave one, and how many ``failed``."""
    errors = F.array(*[F.col(error_column(name)) for name in names])
    marks = F.array(*[F.col(_mark_column(name)) for name in names])
    failed = F.size(F.filter(errors, lambda error: error.isNotNull()))
    return marked.withColumns({"mark": plurality(marks), "failed": failed})


def quarantine(marked: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``(keys, member, error)``: a row for every mark that is missing, to be looked into."""
    pairs = [F.struct(F.lit(name).alias("member"), F.col(error_column(name)).alias("error")) for name in names]
    return marked.select(*keys, F.inline(F.array(*pairs))).where(F.col("error").isNotNull())


def _different(names: Sequence[str]) -> None:
    if len(set(names)) != len(names):
        raise ValueError(f"members need different names: {names}")
