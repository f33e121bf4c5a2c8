"""Learners: one training contract over Spark ML's classifiers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmark import settings
from textmark.operators import features as V
from textmark.operators import metrics, sampling
from textmark.plans.perceptron import sparse_rows, trained_weights
from textmark.runtime import compact

# Added to a member's salt when its classes are balanced.
BALANCE_SALT = "balance"

# A perceptron copies its rows into dense blocks; wide vectors get fewer rows
# per block, so that a block stays within this size.
_BLOCK_BYTES = 64 << 20

# What one task of a tree may read of its rows, whose values it holds dense.
_TREE_BYTES = 256 << 20


@dataclass(frozen=True)
class LearnerSpec:
    """What to train.

    ``target`` turns a learner into a binary one for that mark: classes are
    balanced, labels and marks are 1.0 (target) and 0.0 (any other).  Members
    with different salts see different splits.  ``holdout=False`` fits and
    scores on the same rows.  ``extractor`` and ``places`` choose this member's own
    features of a text (``plans/scoring.py``); empty, it takes those of its scorer.
    """

    kind: str
    name: str = ""
    target: float | None = None
    salt: str = ""
    holdout: bool = True
    seed: int = settings.SHUFFLE_SEED
    extractor: str = ""
    places: int = 0

    @property
    def member(self) -> str:
        return self.name or self.kind

    @property
    def mark_column(self) -> str:
        return f"mark_{self.member}"


@dataclass(frozen=True)
class TrainedMember:
    """A fitted learner and its scored test rows ``(key, label, prediction)``.

    ``features`` names the vectors that it reads.  Naive Bayes over every term has its
    model in a table of all members (``plans/bayes.py``) and none here.
    """

    spec: LearnerSpec
    model: PipelineModel | None
    tested: DataFrame | None = None
    features: str = "features"

    def mark(self, df: DataFrame) -> DataFrame:
        """``df`` with one more column, this member's mark for every row."""
        source = df if self.features == "features" else df.withColumn("features", F.col(self.features))
        scored = self.model.transform(source)
        mark = F.col(f"label_{self.spec.member}").cast("double")
        return scored.select(*df.columns, mark.alias(self.spec.mark_column))

    def score(self) -> DataFrame:
        """Accuracy, and for a binary member the area under its ROC."""
        figures = [metrics.accuracy().alias("accuracy")]
        if self.spec.target is not None:
            figures.append(metrics.auc_of_classes().alias("auc_of_classes"))
        return self.tested.agg(*figures).select(F.lit(self.spec.member).alias("member"), "*")


def raw_column(spec: LearnerSpec) -> str:
    return f"raw_{spec.member}"


def _columns(spec: LearnerSpec) -> dict[str, str]:
    return {
        "labelCol": f"index_{spec.member}",
        "predictionCol": f"prediction_{spec.member}",
        "rawPredictionCol": raw_column(spec),
    }


def _naive_bayes(spec: LearnerSpec, width: int, classes: int) -> list:
    return [
        NaiveBayes(
            modelType="multinomial",
            smoothing=settings.BAYES_SMOOTHING,
            featuresCol="features",
            probabilityCol=f"probability_{spec.member}",
            **_columns(spec),
        )
    ]


def _linear_svm(spec: LearnerSpec, width: int, classes: int) -> list:
    return [
        LinearSVC(
            maxIter=settings.SVM_ITERATIONS,
            regParam=settings.SVM_REGULARISATION,
            featuresCol="features",
            **_columns(spec),
        )
    ]


def _one_vs_rest(spec: LearnerSpec, width: int, classes: int) -> list:
    # The meta-model reads its members' raw scores, and nothing else of them.
    logistic = LogisticRegression(
        maxIter=settings.LOGISTIC_ITERATIONS,
        tol=settings.LOGISTIC_TOLERANCE,
        fitIntercept=False,
        rawPredictionCol=raw_column(spec),
        probabilityCol="",
        predictionCol="",
    )
    return [
        OneVsRest(classifier=logistic, featuresCol="features", parallelism=4, **_columns(spec))
    ]


def _perceptron(spec: LearnerSpec, width: int, classes: int) -> list:
    block = max(1, min(settings.PERCEPTRON_BLOCK, _BLOCK_BYTES // (8 * max(1, width))))
    return [
        MultilayerPerceptronClassifier(
            layers=[width, settings.PERCEPTRON_HIDDEN, classes],
            blockSize=block,
            maxIter=settings.PERCEPTRON_ITERATIONS,
            seed=spec.seed,
            featuresCol="features",
            probabilityCol=f"probability_{spec.member}",
            **_columns(spec),
        )
    ]


def _tree(spec: LearnerSpec, width: int, classes: int) -> list:
    indexed = f"features_{spec.member}"
    return [
        V.category_indexer("features", indexed),
        DecisionTreeClassifier(
            featuresCol=indexed,
            probabilityCol=f"probability_{spec.member}",
            seed=spec.seed,
            **_columns(spec),
        ),
    ]


LEARNERS: dict[str, Callable[[LearnerSpec, int, int], list]] = {
    "naive_bayes": _naive_bayes,
    "linear_svm": _linear_svm,
    "one_vs_rest": _one_vs_rest,
    "perceptron": _perceptron,
    "tree": _tree,
}


def labelled(df: DataFrame, spec: LearnerSpec, key: str, mark: str) -> DataFrame:
    """``(key, label, features)``; for a binary learner relabelled and balanced.

    Rows without vectors come without them.
    """
    vectors = [x for x in ("features",) if x in df.columns]
    # Only the mark is tested: a test of the vectors would be pushed below the text
    # preparation and compute it twice.
    rows = sampling.drop_incomplete(df.select(key, mark, *vectors), mark)
    if spec.target is None:
        return rows.select(key, F.col(mark).cast("double").alias("label"), *vectors)
    classes = sampling.binarise(rows, spec.target, mark).select(key, "label", *vectors)
    # Not the salt of the split: the rows kept of a large class come first in their
    # order, and in the same order they would all be training rows.
    return sampling.balance(classes, key, "label", spec.salt + BALANCE_SALT)


def parts(rows: DataFrame, spec: LearnerSpec, key: str) -> tuple[DataFrame, DataFrame]:
    if not spec.holdout:
        return rows, rows
    return sampling.split(rows, key, spec.salt)


def checked_rows(rows: DataFrame, spec: LearnerSpec) -> int:
    """Number of rows; refuses labels no mark can be learnt from.

    Runs before any label reaches the driver, and fills the kept rows.
    """
    label = F.col("label")
    allowed = sampling.whole_mark(label) if spec.target is None else label.isin(0.0, 1.0)
    seen = rows.agg(
        F.count("*").alias("n"),
        F.count_if(~allowed).alias("strange"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
    ).first()
    if seen["strange"]:
        raise ValueError(f"{spec.member}: {seen['strange']} rows have no whole mark from 1 to 10")
    if seen["low"] == seen["high"]:
        raise ValueError(f"{spec.member}: training needs two marks, found only {seen['low']}")
    return seen["n"]


def train(
    df: DataFrame,
    spec: LearnerSpec,
    key: str = "doc_id",
    mark: str = "rating",
    width: int | None = None,
    features: str = "features",
) -> TrainedMember:
    """Split, fit and prepare the test scores of one learner.

    ``df`` holds the key, the mark and the vectors ``features`` of every labelled row.
    Labels are indexed on the training rows, so a mark that never occurs shifts
    no other, and predictions are turned back into marks by the same index.
    """
    if spec.kind not in LEARNERS:
        raise ValueError(f"no learner {spec.kind!r}; there are {sorted(LEARNERS)}")
    if spec.kind == "linear_svm" and spec.target is None:
        raise ValueError("a linear SVM separates two classes: give a target mark")
    rows = labelled(df.select(key, mark, F.col(features).alias("features")), spec, key, mark)
    fit_rows, test_rows = parts(rows, spec, key)
    # A filter over rows that are kept already needs no second copy of them.
    kept = df.storageLevel.useMemory or df.storageLevel.useDisk
    own_copy = spec.target is not None or not kept
    if own_copy:
        fit_rows = fit_rows.persist(StorageLevel.MEMORY_AND_DISK)
    dealt = None
    try:
        member = spec.member
        indexer = V.label_indexer("label", f"index_{member}")
        if spec.target is not None:
            # 0.0 and 1.0 keep their own indices.
            indexer = indexer.setStringOrderType("alphabetAsc")
        rows = checked_rows(fit_rows, spec)
        dense = compact(fit_rows, rows)
        if spec.kind == "tree":
            width = width or V.vector_width(dense)
            # A tree keeps four bytes a place and row; a task reads them in every level.
            least = -(-rows * 4 * max(1, width) // _TREE_BYTES)
            dense = compact(fit_rows, rows, least=least)
            if dense.rdd.getNumPartitions() < least:
                dense = dealt = fit_rows.repartition(least, key).persist(StorageLevel.MEMORY_AND_DISK)
        index = indexer.fit(dense)
        classes = len(index.labels)
        width = width or V.vector_width(dense)
        stages = LEARNERS[spec.kind](spec, width, classes)
        if spec.kind == "perceptron" and width > settings.PERCEPTRON_DENSE_WIDTH:
            # Spark's classifier takes the weights as they are, and no step.
            sparse = sparse_rows(index.transform(dense), f"index_{member}")
            layers, limit = stages[0].getLayers(), settings.PERCEPTRON_ITERATIONS
            weights = Vectors.dense(trained_weights(sparse, layers, limit, spec.seed))
            stages = [stages[0].setInitialWeights(weights).setMaxIter(0)]
            dense = dense.limit(1)
        named = V.label_names(index.labels, f"prediction_{member}", f"label_{member}")
        fitted = Pipeline(stages=[index, *stages, named]).fit(dense)
    finally:
        if dealt is not None:
            dealt.unpersist()
        if own_copy:
            fit_rows.unpersist()
    # Without the label indexer: scoring needs no label and meets unseen ones.
    model = PipelineModel(fitted.stages[1:])
    trained = TrainedMember(spec, model)
    tested = trained.mark(test_rows).select(
        key, "label", F.col(spec.mark_column).alias("prediction")
    )
    return TrainedMember(spec, model, tested, features)
