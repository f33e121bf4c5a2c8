"""Naive Bayes against its formula; the other learners by their predictions."""

from pyspark.sql import functions as F

from textmark import settings
from textmark.plans.learners import LearnerSpec, train
from textmark.plans.scoring import fit_scorer, fit_words, prepared
from textmark.queries import sql as S
from textmark.queries.registry import query
from textmark.sources import tables
from textmark.sources.words import SAMPLE_STOP_WORDS, sample_lemma_map

_TARGET = 1.0


def text_scorer(reviews, specs, extractor="terms", **options):
    return fit_scorer(
        reviews, specs, lemmas=sample_lemma_map(), stop_words=SAMPLE_STOP_WORDS, extractor=extractor, **options
    )


def words_and_scorer(reviews, specs, **options):
    """The texts' words, made once, and the scorer that is fitted on them."""
    lists = {"lemmas": sample_lemma_map(), "stop_words": SAMPLE_STOP_WORDS}
    words = prepared(reviews, **lists)
    scorer = fit_words(words, specs, extractor="terms", tested=False, **lists, **options)
    return words.dropna(subset=["doc_id"]), scorer


def _tested(reviews, spec, **options):
    return text_scorer(reviews, [spec], **options).members[0].tested


@query(
    "nb_multiclass",
    f"WITH {S.tested(S.LANGUAGE_RATED, [('nb', '')])} SELECT doc_id, label, prediction FROM tested",
)
def nb_multiclass(spark, folder):
    return _tested(tables.language_rated(spark, folder), LearnerSpec("naive_bayes", "nb"))


@query(
    "nb_vocabulary_of_all",
    f"WITH {S.tested(S.LANGUAGE_RATED, [('nb', '')], scope='all')} "
    "SELECT doc_id, label, prediction FROM tested",
)
def nb_vocabulary_of_all(spark, folder):
    """The vocabulary also knows the words of the test texts."""
    spec = LearnerSpec("naive_bayes", "nb")
    return _tested(tables.language_rated(spark, folder), spec, fit_scope="all")


@query(
    "nb_hashed_tfidf",
    f"WITH {S.tested(S.LANGUAGE_RATED, [('nb', '')], places=settings.HASH_BUCKETS)} "
    "SELECT doc_id, label, prediction FROM tested",
)
def nb_hashed_tfidf(spark, folder):
    """Naive Bayes on hashed TF-IDF vectors."""
    spec = LearnerSpec("naive_bayes", "nb")
    return _tested(tables.language_rated(spark, folder), spec, extractor="hashed_tfidf")


@query(
    "nb_multiclass_scores",
    f"WITH {S.bayes(S.LANGUAGE_RATED, [('nb', '')])} "
    "SELECT doc_id, label AS mark, round(score, 3) AS score FROM scores",
)
def nb_multiclass_scores(spark, folder):
    """Log score of every text for every mark."""
    reviews = tables.language_rated(spark, folder)
    words, scorer = words_and_scorer(reviews, [LearnerSpec("naive_bayes", "nb")])
    scores = scorer.terms.scores(words, "doc_id")
    return scores.select("doc_id", F.col("label").alias("mark"), F.round("score", 3).alias("score"))


@query(
    "nb_binary_quality",
    f"WITH {S.tested(S.QUALITY_RATED, [('nb', '')], _TARGET)} "
    "SELECT doc_id, label, prediction FROM tested",
)
def nb_binary_quality(spark, folder):
    spec = LearnerSpec("naive_bayes", "nb", target=_TARGET)
    return _tested(tables.quality_rated(spark, folder), spec)


@query(
    "nb_binary_same_rows",
    f"WITH {S.tested(S.QUALITY_RATED, [('nb', '')], _TARGET, holdout=False)} "
    "SELECT doc_id, label, prediction FROM tested",
)
def nb_binary_same_rows(spark, folder):
    """Fitted and tested on the same balanced rows."""
    spec = LearnerSpec("naive_bayes", "nb", target=_TARGET, holdout=False)
    return _tested(tables.quality_rated(spark, folder), spec)


@query(
    "nb_binary_score",
    f"""WITH {S.tested(S.QUALITY_RATED, [('nb', '')], _TARGET)}
    SELECT 'nb' AS member, avg((prediction = label)::DOUBLE) AS accuracy,
           round((avg(CASE WHEN label = 1 THEN prediction END)
                + avg(CASE WHEN label = 0 THEN 1 - prediction END)) / 2, 9) AS auc_of_classes
    FROM tested""",
)
def nb_binary_score(spark, folder):
    spec = LearnerSpec("naive_bayes", "nb", target=_TARGET)
    scorer = text_scorer(tables.quality_rated(spark, folder), [spec])
    figures = scorer.members[0].score()
    return figures.withColumn("auc_of_classes", F.round("auc_of_classes", 9))


@query("svm_target")
def svm_target(spark, folder):
    spec = LearnerSpec("linear_svm", "svm", target=_TARGET)
    return _tested(tables.quality_rated(spark, folder), spec)


@query("ovr_marks")
def ovr_marks(spark, folder):
    vectors = tables.embedding_marks(spark, folder)
    return train(vectors, LearnerSpec("one_vs_rest", "ovr"), "vec_id").tested


@query("mlp_marks")
def mlp_marks(spark, folder):
    vectors = tables.embedding_marks(spark, folder)
    return train(vectors, LearnerSpec("perceptron", "mlp"), "vec_id").tested


@query("tree_marks")
def tree_marks(spark, folder):
    vectors = tables.embedding_marks(spark, folder)
    return train(vectors, LearnerSpec("tree", "tree"), "vec_id").tested


# Text learners read every term: hashed counts, in a width that suits the learner.
_DENSE = {"extractor": "hashed_counts", "vocabulary_size": settings.DENSE_BUCKETS}


@query("mlp_text")
def mlp_text(spark, folder):
    """A perceptron on hashed counts of all terms."""
    reviews = tables.language_rated(spark, folder)
    return _tested(reviews, LearnerSpec("perceptron", "mlp"), **_DENSE)


@query("tree_text")
def tree_text(spark, folder):
    """A tree on hashed counts of all terms."""
    reviews = tables.language_rated(spark, folder)
    return _tested(reviews, LearnerSpec("tree", "tree"), **_DENSE)


@query("ovr_text")
def ovr_text(spark, folder):
    """One-vs-rest on hashed counts of all terms; its vectors stay sparse."""
    reviews = tables.language_rated(spark, folder)
    return _tested(reviews, LearnerSpec("one_vs_rest", "ovr"), extractor="hashed_counts")


# What SQL can check of the learners it cannot repeat: which rows are tested, their
# labels, and that every prediction is one of the labels.

_MARK_ROWS = f"""SELECT vec_id, (label + 1)::DOUBLE AS label, TRUE AS known FROM embeddings
    WHERE NOT substring(md5(vec_id::VARCHAR), 1, 8) < '{S.TRAIN_LIMIT}'"""


def _known(tested, key, labels):
    known = F.col("prediction").isin([float(label) for label in labels])
    return tested.select(key, "label", F.coalesce(known, F.lit(False)).alias("known"))


@query("ovr_mark_rows", _MARK_ROWS)
def ovr_mark_rows(spark, folder):
    return _known(ovr_marks(spark, folder), "vec_id", range(1, 11))


@query("mlp_mark_rows", _MARK_ROWS)
def mlp_mark_rows(spark, folder):
    return _known(mlp_marks(spark, folder), "vec_id", range(1, 11))


@query("tree_mark_rows", _MARK_ROWS)
def tree_mark_rows(spark, folder):
    return _known(tree_marks(spark, folder), "vec_id", range(1, 11))


@query(
    "mlp_text_rows",
    f"""SELECT doc_id, rating AS label, TRUE AS known FROM ({S.LANGUAGE_RATED})
        WHERE rating IS NOT NULL AND text IS NOT NULL
          AND NOT substring(md5(doc_id::VARCHAR), 1, 8) < '{S.TRAIN_LIMIT}'""",
)
def mlp_text_rows(spark, folder):
    return _known(mlp_text(spark, folder), "doc_id", range(1, len(tables.LANGUAGE_MARKS) + 1))


@query(
    "svm_target_rows",
    f"""WITH {S.bayes(S.QUALITY_RATED, [("svm", "")], _TARGET)}
    SELECT doc_id, label, TRUE AS known FROM labelled WHERE NOT in_train""",
)
def svm_target_rows(spark, folder):
    return _known(svm_target(spark, folder), "doc_id", (0, 1))
