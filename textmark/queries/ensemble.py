"""Votes and ensembles."""

from pyspark.sql import functions as F

from textmark.functions.votes import plurality
from textmark.operators import metrics, voting
from textmark.plans import ensemble
from textmark.plans.learners import LearnerSpec
from textmark.plans.scoring import score_words
from textmark.queries import sql as S
from textmark.queries.learners import text_scorer, words_and_scorer
from textmark.queries.registry import query
from textmark.sources import tables

MEMBERS = [("nb_a", "a"), ("nb_b", "b"), ("nb_c", "c")]
SPECS = [LearnerSpec("naive_bayes", name, salt=salt) for name, salt in MEMBERS]

_USER_MARKS = f"SELECT user_id, prediction AS mark FROM ({S.EVENT_RESULTS})"
_FAILING = f"""SELECT user_id, CASE WHEN member = 'error' THEN -1 WHEN member = 'view' THEN NULL
    ELSE prediction END::DOUBLE AS mark FROM ({S.EVENT_RESULTS})"""
_ANY_MARKS = "SELECT user_id, floor(value) / 2 AS mark FROM events"


def _rounded(votes):
    return votes.withColumn("mark", F.round("mark", 9))


def _rounded_sql(rows, key):
    return f"SELECT {key}, round(mark, 9) AS mark FROM ({S.vote(rows, key)})"


@query("plurality_vote", _rounded_sql(_USER_MARKS, "user_id"))
def plurality_vote(spark, folder):
    return _rounded(
        voting.vote_whole_marks(tables.event_results(spark, folder), "user_id", "prediction")
    )


@query("plurality_vote_any_marks", _rounded_sql(_ANY_MARKS, "user_id"))
def plurality_vote_any_marks(spark, folder):
    rows = tables.table(spark, folder, "events").select(
        "user_id", (F.floor("value") / F.lit(2.0)).alias("mark")
    )
    return _rounded(voting.vote(rows, "user_id"))


def _failing_rows(spark, folder):
    mark = (
        F.when(F.col("member") == "error", F.lit(-1.0))
        .when(F.col("member") != "view", F.col("prediction"))
    )
    return tables.event_results(spark, folder).withColumn("mark", mark)


@query("vote_with_failures", _rounded_sql(_FAILING, "user_id"))
def vote_with_failures(spark, folder):
    return _rounded(voting.vote_whole_marks(_failing_rows(spark, folder), "user_id"))


@query(
    "vote_per_row",
    _rounded_sql(
        """SELECT vec_id, floor(abs(unnest(embedding)) * 20)::DOUBLE AS mark FROM embeddings""",
        "vec_id",
    ),
)
def vote_per_row(spark, folder):
    """Vote of an array of marks inside its row."""
    marks = F.transform("embedding", lambda x: F.floor(F.abs(x) * F.lit(20)).cast("double"))
    vectors = tables.table(spark, folder, "embeddings")
    return vectors.select("vec_id", F.round(plurality(marks), 9).alias("mark"))


def _scorer(spark, folder, **options):
    return text_scorer(tables.language_rated(spark, folder), SPECS, **options)


_MEMBERS_SQL = S.bayes(S.LANGUAGE_RATED, MEMBERS)
_TESTED_SQL = S.tested(S.LANGUAGE_RATED, MEMBERS)


@query(
    "nb_ensemble_vote",
    f"WITH {_MEMBERS_SQL} {_rounded_sql('SELECT doc_id, mark FROM marks', 'doc_id')}",
)
def nb_ensemble_vote(spark, folder):
    marked = score_words(*words_and_scorer(tables.language_rated(spark, folder), SPECS))
    return _rounded(marked.select("doc_id", "mark"))


@query("member_marks", f"WITH {_MEMBERS_SQL} SELECT doc_id, member, mark FROM marks")
def member_marks(spark, folder):
    words, scorer = words_and_scorer(tables.language_rated(spark, folder), SPECS)
    marked = scorer.marks_of_words(words)
    return ensemble.member_rows(marked, ["doc_id"], scorer.members)


@query(
    "member_accuracy",
    f"WITH {_TESTED_SQL} SELECT member, avg((prediction = label)::DOUBLE) AS accuracy "
    "FROM tested GROUP BY member",
)
def member_accuracy(spark, folder):
    return metrics.member_accuracy(ensemble.tested_rows(_scorer(spark, folder).members))


@query(
    "mean_member_accuracy",
    f"""WITH {_TESTED_SQL} SELECT round(avg(accuracy), 9) AS mean_accuracy FROM (
        SELECT member, avg((prediction = label)::DOUBLE) AS accuracy FROM tested GROUP BY member)""",
)
def mean_member_accuracy(spark, folder):
    figures = ensemble.mean_accuracy(_scorer(spark, folder).members)
    return figures.select(F.round("mean_accuracy", 9).alias("mean_accuracy"))
