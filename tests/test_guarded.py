import pandas as pd
import pytest
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import functions as F

from textmark.plans import guarded
from textmark.plans.ensemble import train_members
from textmark.plans.learners import LearnerSpec


def test_rows_that_raise_are_found_by_halving():
    calls = []

    def rate(texts):
        calls.append(len(texts))
        if texts.str.contains("bad").any():
            raise KeyError("bad")
        return texts.str.len()

    texts = pd.Series(["a"] * 1000)
    texts[[17, 600]] = "bad"
    found = guarded.rated(rate, texts)
    assert list(found.index[found["error"].notna()]) == [17, 600]
    assert (found["mark"].drop([17, 600]) == 1).all() and found["mark"][[17, 600]].isna().all()
    assert len(calls) < 50 and set(found["error"].dropna()) == {"KeyError: 'bad'"}


@pytest.mark.parametrize(
    ("rate", "error"),
    [
        (lambda texts: texts.map(lambda text: 11), "no mark: 11.0"),
        (lambda texts: texts.map(lambda text: float("nan")), "no mark: nan"),
        (lambda texts: [1.0, 2.0, 3.0, 4.0], "ValueError: 4 marks for 1 texts"),
    ],
)
def test_what_is_no_mark_is_an_error(rate, error):
    assert list(guarded.rated(rate, pd.Series(["a", "b"]))["error"]) == [error, error]
    assert len(guarded.rated(rate, pd.Series([], dtype=object))) == 0


def test_others_vote_where_one_fails(spark):
    rows = [(1, "7"), (2, "x"), (3, None), (4, ""), (4, "7")]
    texts = spark.createDataFrame(rows, "key long, text string")
    raters = [
        guarded.Rater("int", lambda texts: texts.map(int)),
        guarded.Rater("len", lambda texts: texts.map(lambda text: 2 + len(text))),
    ]
    marked = guarded.vote_of(guarded.with_raters(texts, raters), ["int", "len"])
    found = sorted((r["key"], r["mark"], r["failed"]) for r in marked.collect() if r["mark"] is not None)
    assert found == [(1, 5.0, 0), (2, 3.0, 1), (4, 2.0, 1), (4, 5.0, 0)]
    bad = sorted((r["key"], r["member"], r["error"].split(":")[0]) for r in guarded.quarantine(marked, ["key"], ["int", "len"]).collect())
    assert bad == [(2, "int", "ValueError"), (3, "int", "TypeError"), (3, "len", "TypeError"), (4, "int", "ValueError")]
    with pytest.raises(ValueError, match="different names"):
        guarded.with_raters(texts, raters + raters)


def test_vectors_that_a_model_cannot_take(spark):
    rows = [(i, 1.0 + i % 2, DenseVector([float(i % 2), 1.0 - i % 2, 0.5])) for i in range(60)]
    vectors = spark.createDataFrame(rows, ["doc_id", "rating", "features"])
    members = train_members(vectors, [LearnerSpec(kind, salt=kind) for kind in ("naive_bayes", "one_vs_rest")])
    odd = [
        (1, Vectors.dense([1.0, 0.0, 0.5])),
        (2, Vectors.sparse(3, [0, 2], [1.0, 0.5])),
        (3, None),
        (4, Vectors.dense([1.0, 0.0])),
        (5, Vectors.sparse(3, [1], [float("nan")])),
        (6, Vectors.dense([float("inf"), 0.0, 0.0])),
    ]
    schema = vectors.select(F.lit(1).cast("long").alias("key"), "features").schema
    schema["key"].nullable = True
    asked = spark.createDataFrame(odd, schema)
    names = [member.spec.member for member in members]
    marked = guarded.vote_of(guarded.with_guarded_members(asked, members), names)
    found = {r["key"]: (r["mark"], r["failed"], r["error_naive_bayes"]) for r in marked.collect()}
    assert found[1] == found[2] == (2.0, 0, None)
    assert {key: found[key] for key in (3, 4, 5, 6)} == {
        3: (None, 2, "no vector"),
        4: (None, 2, "width 2, not 3"),
        5: (None, 2, "a value is not finite"),
        6: (None, 2, "a value is not finite"),
    }
    kept = marked.select("key", "features").join(asked.withColumnRenamed("features", "asked"), "key")
    assert all(repr(r["features"]) == repr(r["asked"]) for r in kept.collect())
