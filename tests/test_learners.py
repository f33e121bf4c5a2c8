"""Learners by their properties: every key marked once, marks from the label
set, same seed same result, saved and loaded same result, stream equals batch."""

import functools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textmark import LearnerSpec, Scorer, fit_scorer, score_stream, score_table, score_text, train
from textmark.operators import features as V
from textmark.operators import lookup
from textmark.operators.lookup import lookup_join
from textmark.plans import bayes, ensemble, learners, perceptron
from textmark.plans.ensemble import mark_with_members, train_members

KINDS = ["naive_bayes", "one_vs_rest", "perceptron", "tree"]


@pytest.fixture(scope="module")
def vectors(spark):
    """Three marks, none of them adjacent, told apart by one feature each."""
    rng = random.Random(3)
    marks = [2.0, 5.0, 9.0]
    rows = []
    for key in range(240):
        values = [rng.randint(0, 2) + 0.0 for _ in range(6)]
        values[key % 3] += 6
        rows.append((key, marks[key % 3], values))
    df = spark.createDataFrame(rows, "doc_id long, rating double, v array<double>")
    return df.select("doc_id", "rating", array_to_vector("v").alias("features")).cache()


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("kind", KINDS)
def test_multiclass_learner(vectors, kind):
    member = train(vectors, LearnerSpec(kind, salt="k"))
    tested = rows_of(member.tested)
    keys = [row[0] for row in tested]
    assert len(keys) == len(set(keys)) and 60 < len(keys) < 140
    # Marks 1, 3, 4 ... never occur and shift no other.
    assert {row[2] for row in tested} <= {2.0, 5.0, 9.0}
    score = member.score().first()
    assert score["accuracy"] == pytest.approx(sum(r[1] == r[2] for r in tested) / len(tested))
    assert score["accuracy"] > 0.9
    again = train(vectors, LearnerSpec(kind, salt="k"))
    assert rows_of(again.tested) == tested


@pytest.mark.parametrize("kind", ["naive_bayes", "linear_svm"])
def test_binary_learner(vectors, kind):
    member = train(vectors, LearnerSpec(kind, target=5.0))
    tested = rows_of(member.tested)
    assert {row[1] for row in tested} == {0.0, 1.0} and {row[2] for row in tested} <= {0.0, 1.0}
    score = member.score().first()
    assert score["accuracy"] > 0.8 and score["auc_of_classes"] > 0.8


def test_binary_rows_are_balanced(vectors):
    member = train(vectors, LearnerSpec("naive_bayes", target=5.0, holdout=False))
    labels = Counter(row[1] for row in rows_of(member.tested))
    assert labels == {0.0: 80, 1.0: 80}


def test_training_refuses_what_it_cannot_learn(vectors):
    with pytest.raises(ValueError, match="two marks"):
        train(vectors.where("rating = 5"), LearnerSpec("tree"))
    with pytest.raises(ValueError, match="two marks"):
        train(vectors, LearnerSpec("naive_bayes", target=3.0))
    with pytest.raises(ValueError, match="no whole mark"):
        train(vectors.withColumn("rating", F.lit(7.5)), LearnerSpec("tree"))
    with pytest.raises(ValueError, match="target"):
        train(vectors, LearnerSpec("linear_svm"))
    with pytest.raises(ValueError, match="no learner"):
        train(vectors, LearnerSpec("oracle"))


def test_members_vote_and_a_failing_one_does_not_stop_them(spark, vectors):
    specs = [LearnerSpec(kind, salt=kind) for kind in KINDS]
    members = train_members(vectors, specs, parallelism=2)
    marked = mark_with_members(vectors, members)
    assert marked.count() == 240
    assert marked.where("mark = rating").count() > 200
    assert "Exchange" not in marked._jdf.queryExecution().executedPlan().toString()

    class Broken:
        def transform(self, df):
            raise RuntimeError("lost")

    broken = type(members[0])(LearnerSpec("tree", "broken"), Broken())
    marked = mark_with_members(vectors, [*members, broken])
    assert marked.where("mark_broken is not null").count() == 0
    assert marked.where("mark = rating").count() > 200


GOOD, BAD = "great fine lovely".split(), "awful dull poor".split()


@pytest.fixture(scope="module")
def reviews(spark):
    rng = random.Random(8)
    rows = []
    for key in range(120):
        good = key % 3 != 0
        words = rng.choices(GOOD if good else BAD, k=6) + rng.choices(["film", "the", "Story"], k=4)
        rows.append((key, 9.0 if good else 2.0, " ".join(words)))
    rows += [(900, None, "great"), (901, 9.0, None)]
    return spark.createDataFrame(rows, "doc_id long, rating double, text string")


def brute_force_bayes(training, vocabulary, words, smoothing=0.1875):
    """Best mark by the naive Bayes formula."""
    counts, sizes = defaultdict(Counter), Counter()
    for mark, row in training:
        sizes[mark] += 1
        counts[mark].update(w for w in row if w in vocabulary)
    scores = {}
    for mark, n in sizes.items():
        total = sum(counts[mark].values()) + smoothing * len(vocabulary)
        prior = math.log(n + smoothing) - math.log(len(training) + smoothing * len(sizes))
        scores[mark] = prior + sum(
            math.log((counts[mark][w] + smoothing) / total) for w in words if w in vocabulary
        )
    return max(scores, key=scores.get)


def test_bayes_on_texts_equals_the_formula(reviews):
    spec = LearnerSpec("naive_bayes", "nb")
    scorer = fit_scorer(reviews, [spec], stop_words={"the"})
    tested = {r["doc_id"]: r for r in scorer.members[0].tested.collect()}
    rows = {
        r["doc_id"]: (r["rating"], [w for w in r["text"].lower().split() if w != "the"])
        for r in reviews.dropna().collect()
    }
    training = [row for key, row in rows.items() if key not in tested]
    vocabulary = {w for _, row in training for w in row}
    assert set(scorer.extractor.stages[0].vocabulary) == vocabulary
    for key, row in tested.items():
        assert row["prediction"] == brute_force_bayes(training, vocabulary, rows[key][1])


SPECS = [
    LearnerSpec("naive_bayes", "nb", salt="1"),
    LearnerSpec("one_vs_rest", "ovr", salt="2"),
    LearnerSpec("tree", "tree", salt="3"),
]


def test_scorer_scores_saves_and_loads(spark, reviews, folder):
    scorer = fit_scorer(reviews, SPECS, lemmas={"films": "film"}, stop_words=["the"])
    scored = score_table(reviews.dropna(), scorer)
    assert scored.columns == ["doc_id", "rating", "mark_nb", "mark_ovr", "mark_tree", "mark"]
    assert scored.where("mark = rating").count() > 100
    assert score_text(spark, "A lovely, great film!", scorer) == 9.0
    assert score_text(spark, "", scorer) in (2.0, 5.5, 9.0)
    scorer.save(folder + "/scorer")
    loaded = Scorer.load(spark, folder + "/scorer")
    assert rows_of(score_table(reviews.dropna(), loaded)) == rows_of(scored)


@pytest.mark.parametrize("specs", [SPECS[:1], SPECS], ids=["direct", "by_batch"])
def test_stream_equals_batch(spark, reviews, folder, specs):
    scorer = fit_scorer(reviews, specs)
    texts = reviews.dropna().select("doc_id", "text")
    for part in range(3):
        texts.where(F.col("doc_id") % 3 == part).write.mode("append").parquet(folder + "/in")
    arriving = spark.readStream.schema(texts.schema).option("maxFilesPerTrigger", 2).parquet(folder + "/in")
    for _ in range(2):  # the second start finds nothing new
        score_stream(arriving, scorer, folder + "/out", folder + "/state").awaitTermination()
    streamed = spark.read.parquet(folder + "/out").select("doc_id", "mark")
    assert rows_of(streamed) == rows_of(score_table(texts, scorer).select("doc_id", "mark"))


def test_figures_about_members_read_no_text(spark, reviews):
    scorer = fit_scorer(reviews, SPECS[:2])
    tested = ensemble.tested_rows(scorer.members)
    plan = tested._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan and tested.count() > 0


def test_hashed_tfidf_scorer(reviews):
    scorer = fit_scorer(reviews, SPECS[:1], extractor="hashed_tfidf", vocabulary_size=1 << 10)
    assert score_table(reviews.dropna(), scorer).where("mark = rating").count() > 100
    with pytest.raises(ValueError, match="no extractor"):
        fit_scorer(reviews, SPECS[:1], extractor="pixels")


@pytest.mark.parametrize("name", ["mlp_text", "tree_text", "ovr_text"])
def test_text_learners_see_rare_terms(spark, folder, name):
    """What tells the marks apart stands behind more than 1000 frequent terms."""
    from textmark.queries.registry import queries

    common = " ".join(a + b + c for a in "bcdfghjklm" for b in "aeiouxyzvw" for c in "bcdfghjklmnp")
    rows = []
    for key in range(80):
        lang = ("de", "en")[key % 2]
        rows.append((key, lang, f"{common} {common} {('qdequ', 'qenqu')[key % 2]}"))
    documents = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    documents.write.parquet(f"{folder}/documents.parquet")
    tested = rows_of(queries()[name](spark, str(folder)))
    assert len(tested) > 15 and all(label == prediction for _, label, prediction in tested)


def test_terms_beyond_the_width_are_counted(spark, caplog):
    words = spark.createDataFrame([(0, ["a", "a", "b", "c"])], "doc_id long, words array<string>")
    with caplog.at_level("WARNING"):
        assert V.vocabulary(words, 2).count() == 2
    assert "1 of 3 terms are beyond" in caplog.text


def test_fit_scope(reviews):
    spec = LearnerSpec("naive_bayes", "nb")
    only = reviews.unionByName(reviews.limit(1).selectExpr("doc_id + 5000 as doc_id", "9.0D as rating", "'unique' as text"))
    everything = fit_scorer(only, [spec], fit_scope="all").extractor.stages[0].vocabulary
    trained = fit_scorer(only, [spec]).extractor.stages[0].vocabulary
    assert set(trained) <= set(everything) and "unique" in everything


@pytest.mark.parametrize("size", [3, 20_000])
def test_vocabulary_order_is_total(spark, size):
    rows = spark.createDataFrame([(["b", "a", "c", "a"],), (["d", "b"],), ([],)], "words array<string>")
    found = sorted(tuple(r) for r in V.vocabulary(rows, size).collect())
    assert found == [(0, "a", 2), (1, "b", 2), (2, "c", 1), (3, "d", 1)][:size]


def test_large_vocabulary_model(spark):
    listed = [f"t{i}ż" for i in range(1500)]
    row = spark.createDataFrame([(["t1ż", "t1ż", "t1499ż", "other"],)], "words array<string>")
    vector = V.vectoriser(listed).transform(row).first()["features"]
    assert vector.size == 1500 and dict(zip(vector.indices.tolist(), vector.values.tolist())) == {1: 2.0, 1499: 1.0}


def test_empty_text_keeps_its_row_with_an_empty_vector(spark):
    row = spark.createDataFrame([([],)], "words array<string>")
    assert V.vectoriser(["a"]).transform(row).first()["features"].numNonzeros() == 0


def test_categories(spark):
    rows = [([float(i % 3), float(i)],) for i in range(12)]
    df = spark.createDataFrame(rows, "v array<double>").select(array_to_vector("v").alias("features"))
    model = V.category_indexer().fit(df)
    assert {int(k): dict(v) for k, v in model.categoryMaps.items()} == {0: {0.0: 0, 1.0: 1, 2.0: 2}}
    unseen = df.limit(1).select(F.lit(7.0).alias("x")).select(array_to_vector(F.array("x", "x")).alias("features"))
    assert model.transform(unseen).first()["indexed_features"][0] == 3.0


def test_terms_beside_vectors_of_every_term(spark, reviews, folder, monkeypatch):
    """The table of terms gives the marks that Spark's own naive Bayes gives on whole vectors."""
    specs = [LearnerSpec("naive_bayes", "a", salt="a"), LearnerSpec("naive_bayes", "t", salt="t", target=9.0)]
    marks = ["mark_a", "mark_t"]
    vectors = fit_scorer(reviews, specs, stop_words=["the"])
    terms = fit_scorer(reviews, specs, stop_words=["the"], extractor="terms")
    assert terms.extractor is None and terms.columns == []
    texts = reviews.dropna()
    want = rows_of(vectors.marks(texts, "doc_id", "text").select("doc_id", *marks))
    assert rows_of(terms.marks(texts, "doc_id", "text").select("doc_id", *marks)) == want
    for one, other in zip(vectors.members, terms.members, strict=True):
        assert rows_of(one.tested) == rows_of(other.tested)
    # Beyond a broadcast the table is joined by shuffle.
    monkeypatch.setattr(bayes, "lookup_join", functools.partial(lookup_join, max_rows=1))
    assert rows_of(terms.marks(texts, "doc_id", "text").select("doc_id", *marks)) == want
    terms.save(folder + "/terms")
    loaded = Scorer.load(spark, folder + "/terms")
    assert rows_of(loaded.marks(texts, "doc_id", "text").select("doc_id", *marks)) == want
    # No word at all, and none that is known: the most frequent label, and rows of one key stay apart.
    odd = spark.createDataFrame([(1, ""), (1, "zzzz qqqq"), (1, "lovely great"), (2, None)], "doc_id long, text string")
    scored = terms.marks(odd, "doc_id", "text").select("doc_id", "mark_a").collect()
    assert len(scored) == 4 and all(row["mark_a"] is not None for row in scored)


def test_members_with_features_of_their_own(spark, reviews, folder):
    specs = [
        LearnerSpec("naive_bayes", "nb"),
        LearnerSpec("perceptron", "mlp", places=64),
        LearnerSpec("tree", "tree", extractor="counts", places=50),
    ]
    scorer = fit_scorer(reviews, specs, extractor="terms")
    assert scorer.columns == ["features_counts_50", "features_hashed_counts_64"]
    texts = reviews.dropna()
    scored = score_table(texts, scorer)
    assert scored.columns[-4:] == ["mark_nb", "mark_mlp", "mark_tree", "mark"]
    assert scored.where("mark = rating").count() > 100
    assert {row["member"] for row in ensemble.tested_rows(scorer.members).select("member").distinct().collect()} == {"nb", "mlp", "tree"}
    scorer.save(folder + "/own")
    loaded = Scorer.load(spark, folder + "/own")
    assert rows_of(score_table(texts, loaded).select("doc_id", "mark")) == rows_of(scored.select("doc_id", "mark"))
    with pytest.raises(ValueError, match="only naive Bayes"):
        fit_scorer(reviews, [LearnerSpec("tree", extractor="terms")])


def test_frequent_terms_are_sent_and_the_others_shuffled(spark, reviews, monkeypatch):
    """Marks are the same wherever the cut between them lies, and no more than the bound is sent."""
    specs = [LearnerSpec("naive_bayes", "a", salt="a"), LearnerSpec("naive_bayes", "t", salt="t", target=9.0)]
    whole = fit_scorer(reviews, specs, stop_words=["the"], extractor="terms")
    assert whole.terms.least_seen is None
    texts = reviews.dropna()
    want = rows_of(whole.marks(texts, "doc_id", "text").select("doc_id", "mark_a", "mark_t"))
    tested = [rows_of(member.tested) for member in whole.members]
    size = whole.terms.weights.count()
    for bytes_ in (0, 600):
        monkeypatch.setattr(bayes, "least_frequent", functools.partial(lookup.least_frequent, max_bytes=bytes_))
        cut = fit_scorer(reviews, specs, stop_words=["the"], extractor="terms")
        sent = cut.terms.weights.where(F.col("seen") >= cut.terms.least_seen).count()
        assert sent * 64 <= bytes_ and sent < size and (sent > 0) == (bytes_ > 0)
        assert rows_of(cut.marks(texts, "doc_id", "text").select("doc_id", "mark_a", "mark_t")) == want
        assert [rows_of(member.tested) for member in cut.members] == tested
    assert fit_scorer(reviews, specs, extractor="terms", tested=False).members[0].tested is None


def test_stream_of_a_table_in_several_files(spark, folder):
    """The table may be a folder of files, and is scored whole."""
    rows = [(key, ("de", "en")[key % 2], ("gut schön", "good fine")[key % 2]) for key in range(40)]
    documents = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    documents.repartition(2).write.parquet(f"{folder}/documents.parquet")
    from textmark.queries.registry import queries

    assert queries()["score_stream"](spark, str(folder)).count() == 40


def test_wide_perceptron_trains_on_sparse_rows(spark, monkeypatch):
    """No dense copy of the rows; the gradient is that of the loss, and Spark's model has the weights."""
    rng = np.random.default_rng(5)
    layers, starts = [6, 3, 2], np.array([0, 2, 2, 5])
    places, values = np.array([0, 4, 1, 2, 5]), np.array([1.0, 2.0, 3.0, 1.0, 0.5])
    weights, labels = rng.normal(size=6 * 3 + 3 + 3 * 2 + 2), np.array([1, 0, 1])
    loss = lambda w: perceptron.gradient(labels, starts, places, values, w, layers)[0]
    steps = 1e-6 * np.eye(len(weights))
    slope = [(loss(weights + step) - loss(weights - step)) / 2e-6 for step in steps]
    assert np.allclose(perceptron.gradient(labels, starts, places, values, weights, layers)[1], slope, atol=1e-5)

    width, marks = 5000, [2.0, 5.0, 9.0]
    rows = [(k, marks[k % 3], Vectors.sparse(width, [k % 3, 3 + k % 4990], [4.0, 1.0])) for k in range(120)]
    df = spark.createDataFrame(rows, ["doc_id", "rating", "features"]).cache()
    seen = []
    stacked = lambda rows, *args: seen.append(args[0]) or trained(rows, *args)
    trained = learners.trained_weights
    monkeypatch.setattr(learners, "trained_weights", stacked)
    member = train(df, LearnerSpec("perceptron", "mlp"))
    assert seen == [[width, 5, 3]] and member.score().first()["accuracy"] > 0.9
    model = member.model.stages[0]
    rows = df.where("doc_id < 3").orderBy("doc_id").collect()
    one, b1, two, b2 = perceptron._layers(model.weights.toArray(), [width, 5, 3])
    for row in rows:
        hidden = 1 / (1 + np.exp(-(row["features"].toArray() @ one + b1)))
        assert np.argmax(hidden @ two + b2) == model.predict(row["features"])


def test_tree_reads_bounded_bytes_in_a_task(spark, vectors, monkeypatch):
    """Rows are dealt so that a task's dense values stay within the bound, however few cores."""
    want = rows_of(train(vectors, LearnerSpec("tree", salt="k")).tested)
    seen = []
    monkeypatch.setattr(learners, "_TREE_BYTES", 160, raising=False)
    fit = learners.Pipeline.fit
    monkeypatch.setattr(learners.Pipeline, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    assert rows_of(train(vectors.coalesce(1), LearnerSpec("tree", salt="k")).tested) == want
    assert seen[0] >= 240 * 0.4 * 24 / 160


def test_tfidf_of_rare_terms_is_shuffled_and_equal(spark, monkeypatch):
    rows = [(key, ["often"] * 3 + [f"w{key % 7}", f"only{key}"]) for key in range(40)]
    bag = V.bag_of_words(spark.createDataFrame(rows, "doc_id long, words array<string>"), "doc_id")
    want = rows_of(V.tfidf(bag, "doc_id", 40))
    assert len(want) == 120
    for bytes_ in (0, 60):
        monkeypatch.setattr(V, "least_frequent", functools.partial(lookup.least_frequent, max_bytes=bytes_))
        assert rows_of(V.tfidf(bag, "doc_id", 40)) == want


@pytest.mark.parametrize("name", ["score_table", "score_beside_truth", "nb_ensemble_vote", "vote_accuracy"])
def test_texts_that_train_and_are_scored_are_prepared_once(spark, folder, monkeypatch, name):
    rows = [(key, ("de", "en")[key % 2], ("gut schön", "good fine")[key % 2]) for key in range(40)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(f"{folder}/documents.parquet")
    from textmark.plans import scoring
    from textmark.queries.registry import queries

    calls, real = [], scoring.prepare_words
    monkeypatch.setattr(scoring, "prepare_words", lambda *a, **b: calls.append(1) or real(*a, **b))
    assert queries()[name](spark, str(folder)).count() == (1 if name == "vote_accuracy" else 40)
    assert len(calls) == 1


@pytest.mark.parametrize("at_once", [1, 7, 1 << 20])
def test_frequent_words_add_up_in_their_array(spark, monkeypatch, at_once):
    """No row is made of a frequent word; null and empty texts have sums, equal keys stay as they are."""
    monkeypatch.setattr(bayes, "_WORDS_AT_ONCE", at_once)
    often = spark.createDataFrame([("a", 1.0, 10.0), ("b", 2.0, 20.0)], "term string, g0 double, g1 double")
    texts = [(1, ["a", "x", "b", "a"]), (2, []), (3, None), (4, ["y", "x"]), (4, ["b"]), (5, ["a"] * 50)]
    df = spark.createDataFrame(texts, "key int, words array<string>")
    got = rows_of(bayes.frequent_sums(df, "key", often, 2))
    assert got == [
        (1, 3, 4.0, 40.0, ["x"]), (2, 0, 0.0, 0.0, []), (3, 0, 0.0, 0.0, []),
        (4, 0, 0.0, 0.0, ["y", "x"]), (4, 1, 2.0, 20.0, []), (5, 50, 50.0, 500.0, []),
    ]
