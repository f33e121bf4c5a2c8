"""From raw labelled texts to a scorer, and from a scorer to marks."""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import OneVsRestModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmark import settings
from textmark.operators import features as V
from textmark.operators.sampling import drop_incomplete
from textmark.operators.tokens import prepare_words
from textmark.plans.bayes import ROW, TermModel, fit_terms, numbered, scope
from textmark.plans.ensemble import train_members, voted, with_member_marks, with_written_tests
from textmark.plans.learners import LearnerSpec, TrainedMember, raw_column


@dataclass(frozen=True)
class Scorer:
    """Word lists, extractors and members: all that a text needs to get a mark.

    ``extractor`` makes every vector column that some member reads; ``terms`` is the table
    of the members that read terms instead.
    """

    extractor: PipelineModel | None
    members: tuple[TrainedMember, ...]
    lemmas: Mapping[str, str] | DataFrame
    stop_words: Collection[str] | DataFrame
    filter_on: str = "stem"
    terms: TermModel | None = None

    @property
    def columns(self) -> list[str]:
        """The vector columns of the members."""
        return sorted({member.features for member in self.members if member.model is not None})

    def words(self, df: DataFrame, key: str, text: str) -> DataFrame:
        return prepare_words(df, key, text, self.lemmas, self.stop_words, self.filter_on)

    def vectors(self, df: DataFrame, key: str, text: str) -> DataFrame:
        return V.extract(self.extractor, self.words(df, key, text), *self.columns).drop("words")

    def marks(self, df: DataFrame, key: str, text: str) -> DataFrame:
        """``df`` without ``text``, with the mark column of every member."""
        return self.marks_of_words(self.words(df, key, text))

    def marks_of_words(self, rows: DataFrame) -> DataFrame:
        """The marks of texts whose ``words`` are made, such as those of ``prepared``.

        Members that read vectors need no shuffle; those that read terms join their table.
        """
        columns = rows.drop("words", ROW).columns
        if self.columns:
            by_vector = [member for member in self.members if member.model is not None]
            rows = with_member_marks(V.extract(self.extractor, rows, *self.columns), by_vector)
            rows = rows.drop(*self.columns)
        if self.terms is not None:
            rows = self.terms.marked(rows)
        return rows.select(*columns, *[member.spec.mark_column for member in self.members])

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        if self.extractor is not None:
            self.extractor.write().overwrite().save(f"{path}/extractor")
        for number, member in enumerate(self.members):
            if member.model is not None:
                member.model.write().overwrite().save(f"{path}/member-{number}")
        if self.terms is not None:
            self.terms.save(f"{path}/terms")
        lemmas, stops = self.lemmas, self.stop_words
        if isinstance(lemmas, DataFrame):
            lemmas.write.mode("overwrite").parquet(f"{path}/lemmas")
        if isinstance(stops, DataFrame):
            stops.write.mode("overwrite").parquet(f"{path}/stop_words")
        settings_row = {
            "members": [asdict(member.spec) for member in self.members],
            "features": [member.features if member.model is not None else None for member in self.members],
            "lemmas": None if isinstance(lemmas, DataFrame) else dict(lemmas),
            "stop_words": None if isinstance(stops, DataFrame) else sorted(stops),
            "filter_on": self.filter_on,
        }
        one_row = spark.createDataFrame([(json.dumps(settings_row),)], "value string")
        one_row.coalesce(1).write.mode("overwrite").text(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Scorer":
        stored = json.loads(spark.read.text(f"{path}/settings", wholetext=True).first()["value"])
        specs = [LearnerSpec(**spec) for spec in stored["members"]]
        features = stored["features"]
        members = tuple(
            TrainedMember(spec, None) if column is None else _load_member(spec, f"{path}/member-{number}", column)
            for number, (spec, column) in enumerate(zip(specs, features, strict=True))
        )
        by_term = [spec for spec, column in zip(specs, features, strict=True) if column is None]
        lemmas, stops = stored["lemmas"], stored["stop_words"]
        return cls(
            PipelineModel.load(f"{path}/extractor") if any(features) else None,
            members,
            spark.read.parquet(f"{path}/lemmas") if lemmas is None else lemmas,
            spark.read.parquet(f"{path}/stop_words") if stops is None else stops,
            stored["filter_on"],
            TermModel.load(spark, f"{path}/terms", by_term) if by_term else None,
        )


def _load_member(spec: LearnerSpec, path: str, features: str) -> TrainedMember:
    model = PipelineModel.load(path)
    for stage in model.stages:
        # The stored form of this model forgets its raw score column.
        if isinstance(stage, OneVsRestModel):
            stage.setRawPredictionCol(raw_column(spec))
    return TrainedMember(spec, model, features=features)


def fit_rows(words: DataFrame, specs: Sequence[LearnerSpec], key: str, fit_scope: str) -> DataFrame:
    """The rows the vocabulary is taken from.

    ``"train"``: rows that some member is fitted on.  ``"all"``: every labelled
    row, so test texts leak into the vocabulary.
    """
    return words.where(scope(key, specs, fit_scope))


def own_features(spec: LearnerSpec, extractor: str, size: int) -> tuple[str, int]:
    """Extractor and width of one member.

    Beside members that read terms, a learner of another kind takes hashed counts, which
    cover every term too: few places for those that hold dense values per place.
    """
    kind = spec.extractor or extractor
    if kind != "terms":
        return kind, spec.places or size
    if spec.kind == "naive_bayes":
        return kind, 0
    if spec.extractor:
        raise ValueError(f"{spec.member}: only naive Bayes reads terms, not {spec.kind}")
    dense = spec.kind in ("perceptron", "tree")
    return "hashed_counts", spec.places or (settings.DENSE_BUCKETS if dense else settings.HASH_BUCKETS)


def prepared(
    reviews: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    mark: str = "rating",
    lemmas: Mapping[str, str] | DataFrame | None = None,
    stop_words: Collection[str] | DataFrame | None = None,
    filter_on: str = "stem",
) -> DataFrame:
    """``(key, mark, words)`` of the complete reviews, written.

    For ``fit_words`` and ``score_words``: texts that train a scorer and are scored by it are
    prepared once.
    """
    return numbered(_clean_words(reviews, key, text, mark, lemmas, stop_words, filter_on))


def _clean_words(reviews, key, text, mark, lemmas, stop_words, filter_on) -> DataFrame:
    clean = drop_incomplete(reviews.select(key, mark, text), mark, text)
    return prepare_words(clean, key, text, {} if lemmas is None else lemmas, () if stop_words is None else stop_words, filter_on)


def fit_scorer(
    reviews: DataFrame,
    specs: Sequence[LearnerSpec],
    key: str = "doc_id",
    text: str = "text",
    mark: str = "rating",
    lemmas: Mapping[str, str] | DataFrame | None = None,
    stop_words: Collection[str] | DataFrame | None = None,
    filter_on: str = "stem",
    vocabulary_size: int = settings.VOCABULARY_SIZE,
    extractor: str = "counts",
    fit_scope: str = "train",
    parallelism: int = 4,
    tested: bool = True,
) -> Scorer:
    """Clean, prepare, fit the extractor and train every member.

    ``extractor`` is ``"terms"`` (naive Bayes over every term, without vectors),
    ``"counts"`` (bag of words), ``"hashed_counts"`` or ``"hashed_tfidf"``; a spec may choose
    its own.  Terms and hashed vectors cover every term; counts drop those beyond
    ``vocabulary_size`` and say how many.  Words are prepared once for all members.  The
    vectors of all members are kept together; before they are released every member's test
    rows are scored from them and written, so figures about members read narrow rows, never
    the texts again.  ``tested=False`` leaves that out, for a scorer that is only applied.
    """
    words = _clean_words(reviews, key, text, mark, lemmas, stop_words, filter_on)
    return fit_words(
        words, specs, key, mark, lemmas, stop_words, filter_on, vocabulary_size, extractor, fit_scope, parallelism, tested
    )


def fit_words(
    words: DataFrame,
    specs: Sequence[LearnerSpec],
    key: str = "doc_id",
    mark: str = "rating",
    lemmas: Mapping[str, str] | DataFrame | None = None,
    stop_words: Collection[str] | DataFrame | None = None,
    filter_on: str = "stem",
    vocabulary_size: int = settings.VOCABULARY_SIZE,
    extractor: str = "counts",
    fit_scope: str = "train",
    parallelism: int = 4,
    tested: bool = True,
) -> Scorer:
    """``fit_scorer`` on prepared ``(key, mark, words)``.

    The word lists and ``filter_on`` are those that made the words; the scorer keeps them.
    """
    lemmas = {} if lemmas is None else lemmas
    stop_words = () if stop_words is None else stop_words
    chosen = {spec.member: own_features(spec, extractor, vocabulary_size) for spec in specs}
    if len(chosen) != len(specs):
        raise ValueError(f"members need different names: {[spec.member for spec in specs]}")
    by_term = [spec for spec in specs if chosen[spec.member][0] == "terms"]
    by_vector = [spec for spec in specs if chosen[spec.member][0] != "terms"]
    kinds = sorted({chosen[spec.member] for spec in by_vector})
    column = {x: "features" if len(kinds) == 1 else f"features_{x[0]}_{x[1]}" for x in kinds}
    if by_term or len(kinds) > 1:
        words = numbered(words)
    terms, fitted, done = None, None, {}
    if by_term:
        terms, members = fit_terms(words, by_term, key, mark, fit_scope, tested)
        done |= {member.spec.member: member for member in members}
    if by_vector:
        seen = fit_rows(words, by_vector, key, fit_scope)
        models = [V.fit_extractor(kind, seen, size, column[kind, size]) for kind, size in kinds]
        fitted = models[0] if len(models) == 1 else PipelineModel([stage for x in models for stage in x.stages])
        features = {spec.member: column[chosen[spec.member]] for spec in by_vector}
        vectors = V.extract(fitted, words, *column.values()).drop("words").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            members = train_members(vectors, by_vector, key, mark, None, parallelism, features)
            members = with_written_tests(members) if tested else [replace(x, tested=None) for x in members]
            done |= {member.spec.member: member for member in members}
        finally:
            vectors.unpersist()
    return Scorer(fitted, tuple(done[spec.member] for spec in specs), lemmas, stop_words, filter_on, terms)


def score_table(df: DataFrame, scorer: Scorer, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Marks for a whole table; every other column, such as the truth, stays.

    With literal word lists and vectors this is one projection over the scan; members that
    read terms add a join.
    """
    return score_words(scorer.words(df, key, text), scorer)


def score_words(words: DataFrame, scorer: Scorer) -> DataFrame:
    """``score_table`` of texts whose words are prepared."""
    return voted(scorer.marks_of_words(words), scorer.members)


def one_text(spark: SparkSession, text: str, key: str = "doc_id") -> DataFrame:
    """A single text as a dataset."""
    return spark.createDataFrame([(0, text)], f"{key} long, text string")


def score_text(spark: SparkSession, text: str, scorer: Scorer) -> float | None:
    """Mark of one text, by the same plan as a table of texts."""
    return score_table(one_text(spark, text), scorer).first()["mark"]


def beside_truth(scored: DataFrame, truth: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, prediction, label)`` when the truth is another table."""
    marks = scored.select(key, F.col("mark").alias("prediction"))
    return marks.join(truth.select(key, F.col("rating").alias("label")), key)
