"""Several learners over the same vectors, one mark by plurality vote."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmark.functions.votes import plurality
from textmark.operators import metrics, sampling
from textmark.plans.learners import LearnerSpec, TrainedMember, train
from textmark.runtime import written

log = logging.getLogger(__name__)

def train_members(
    df: DataFrame,
    specs: Sequence[LearnerSpec],
    key: str = "doc_id",
    mark: str = "rating",
    width: int | None = None,
    parallelism: int = 4,
    features: Mapping[str, str] | None = None,
) -> list[TrainedMember]:
    """Train every spec on ``df``; persist ``df`` first, each member reads it.

    With ``parallelism`` above one the members' jobs share the cluster.  ``features`` names
    the vectors of members that do not read ``features``.
    """
    names = [spec.member for spec in specs]
    if len(set(names)) != len(names):
        raise ValueError(f"members need different names: {names}")

    def fit(spec: LearnerSpec) -> TrainedMember:
        return train(df, spec, key, mark, width, (features or {}).get(spec.member, "features"))

    if parallelism <= 1:
        return [fit(spec) for spec in specs]
    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(df.sparkSession)(fit), specs)


def with_member_marks(df: DataFrame, members: Sequence[TrainedMember]) -> DataFrame:
    """One ``mark_<member>`` column per member, in one projection.

    A member that is lost, so that its model cannot be applied, gives NULL and the
    others still vote.  A member that is misconfigured, such as one of another width or
    without its columns, raises instead: that is no missing vote.
    """
    marked = df
    for member in members:
        try:
            marked = member.mark(marked)
        except (ValueError, TypeError, AnalysisException, IllegalArgumentException):
            raise
        except Exception as error:
            log.warning("member %s gives no mark: %s", member.spec.member, error)
            marked = marked.withColumn(member.spec.mark_column, F.lit(None).cast("double"))
    return marked


def mark_with_members(df: DataFrame, members: Sequence[TrainedMember]) -> DataFrame:
    """``df`` with the members' marks and the voted ``mark``; no shuffle."""
    return voted(with_member_marks(df, members), members)


def voted(marked: DataFrame, members: Sequence[TrainedMember]) -> DataFrame:
    """The ``mark`` that the members' mark columns make together."""
    votes = F.array(*[F.col(member.spec.mark_column) for member in members])
    return marked.withColumn("mark", plurality(votes))


def member_rows(marked: DataFrame, keys: Sequence[str], members: Sequence[TrainedMember]) -> DataFrame:
    """Marks in long form: ``(keys, member, mark)``, one row per text and member."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(member.spec.member).alias("member"),
                F.col(member.spec.mark_column).alias("mark"),
            )
            for member in members
        ]
    )
    return marked.select(*keys, F.inline(pairs))


def tested_rows(members: Sequence[TrainedMember]) -> DataFrame:
    """All members' scored test rows: ``(member, key, label, prediction)``."""
    return sampling.union_labelled(
        *[
            member.tested.select(F.lit(member.spec.member).alias("member"), "*")
            for member in members
        ]
    )


def with_written_tests(members: Sequence[TrainedMember]) -> list[TrainedMember]:
    """The members with their scored test rows computed now, all in one job."""
    rows = written(tested_rows(members), "tested-rows")

    def of(member: TrainedMember) -> DataFrame:
        return rows.where(F.col("member") == member.spec.member).drop("member")

    return [replace(member, tested=of(member)) for member in members]


def mean_accuracy(members: Sequence[TrainedMember]) -> DataFrame:
    return metrics.mean_member_accuracy(tested_rows(members))
