from collections import Counter

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from textmark.functions.votes import plurality
from textmark.operators import metrics, sampling, voting

VOTES = {
    "winner": [3.0, 3.0, 7.0],
    "two_way": [2.0, 5.0],
    "three_way": [1.0, 1.0, 4.0, 4.0, 9.0, 9.0, 8.0],
    "one_failed": [-1.0, 6.0, 6.0],
    "missing": [None, 10.0],
    "all_failed": [-1.0, None],
    "single": [8.0],
}


def brute_force(marks):
    given = Counter(mark for mark in marks if mark is not None and mark != -1)
    if not given:
        return None
    tied = [mark for mark, n in given.items() if n == max(given.values())]
    return sum(tied) / len(tied)


EXPECTED = {key: brute_force(marks) for key, marks in VOTES.items()}


def test_votes_of_rows(spark):
    rows = [(key, mark) for key, marks in VOTES.items() for mark in marks]
    long = spark.createDataFrame(rows, "id string, mark double")
    for voted in (voting.vote(long, "id"), voting.vote_whole_marks(long, "id")):
        assert {r["id"]: r["mark"] for r in voted.collect()} == pytest.approx(EXPECTED)


def test_vote_of_an_array(spark):
    wide = spark.createDataFrame(list(VOTES.items()), "id string, marks array<double>")
    voted = wide.select("id", plurality(F.col("marks")).alias("mark"))
    assert {r["id"]: r["mark"] for r in voted.collect()} == pytest.approx(EXPECTED)
    assert "Exchange" not in voted._jdf.queryExecution().executedPlan().toString()


def test_vote_of_fractional_marks(spark):
    rows = spark.createDataFrame([(1, 2.5), (1, 2.5), (1, 4.0)], "id int, mark double")
    assert voting.vote(rows, "id").first()["mark"] == 2.5


@pytest.mark.parametrize("marks", [(5.5, 5.5, 3.0), (11.0,), (0.0, 2.0)])
def test_marks_that_are_not_whole_are_refused(spark, marks):
    rows = spark.createDataFrame([(1, m) for m in marks], "id int, mark double")
    with pytest.raises(Exception, match="not whole"):
        voting.vote_whole_marks(rows, "id").collect()
    assert voting.vote(rows, "id").first()["mark"] == brute_force(marks)


def test_a_missing_prediction_is_a_miss(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (None, 2.0), (None, 3.0), (4.0, None)], "prediction double, label double")
    assert rows.agg(metrics.accuracy()).first()[0] == pytest.approx(1 / 3)


def test_a_hot_key_votes_once_per_task(spark):
    rows = spark.range(100_000).select(F.lit(1).alias("id"), (1.0 + F.col("id") % 4).alias("mark"))
    assert voting.vote_whole_marks(rows, "id").first()["mark"] == 2.5
    plan = voting.vote_whole_marks(rows, "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Window" not in plan


RESULTS = [(1.0, 1.0), (0.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]


def test_metrics_agree_with_evaluators(spark):
    results = spark.createDataFrame(RESULTS, "prediction double, label double")
    ours = results.agg(
        metrics.accuracy().alias("accuracy"), metrics.auc_of_classes().alias("auc")
    ).first()
    assert ours["accuracy"] == pytest.approx(
        MulticlassClassificationEvaluator(metricName="accuracy").evaluate(results)
    )
    assert ours["auc"] == pytest.approx(
        BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(results)
    )


def test_error_report(spark):
    results = spark.createDataFrame([(3.0, 3.0), (5.0, 1.0), (2.0, 4.0)], "prediction double, label double")
    report = metrics.error_report(results).first()
    assert (report["n"], report["max_error"]) == (3, 4.0)
    assert report["accuracy"] == pytest.approx(1 / 3) and report["mean_error"] == pytest.approx(2.0)


def test_mean_member_accuracy_is_not_pooled(spark):
    rows = [("a", 1.0, 1.0)] * 9 + [("a", 1.0, 2.0)] + [("b", 1.0, 2.0)]
    results = spark.createDataFrame(rows, "member string, prediction double, label double")
    assert metrics.mean_member_accuracy(results).first()[0] == pytest.approx(0.45)


def test_label_shift_and_back(spark):
    marks = spark.createDataFrame([(1.0,), (10.0,)], "rating double")
    shifted = sampling.to_mark(sampling.to_class_index(marks), "label")
    assert [tuple(r) for r in shifted.collect()] == [(1.0, 0.0, 1.0), (10.0, 9.0, 10.0)]


def test_valid_marks(spark):
    marks = spark.createDataFrame([(0.0,), (1.0,), (7.5,), (10.0,), (11.0,), (None,)], "rating double")
    assert [r[0] for r in sampling.valid_marks(marks).collect()] == [1.0, 10.0]


def test_drop_failed(spark):
    marks = spark.createDataFrame([(-1.0,), (None,), (4.0,)], "mark double")
    assert [r[0] for r in sampling.drop_failed(marks).collect()] == [4.0]
