"""Naive Bayes over every term: a model that is a table, scores by join and sum.

The model has one row per term and one column per member and label: what a single
occurrence of the term adds to that label's log score.  No vocabulary, vector or weight
passes the driver, which holds the labels (ten at most per member) and their totals.

Prepared words are written once and read where they are needed, exploded but never
shuffled: fitting shuffles the counts per term, combined in each task before, for all members
together.  Scoring sends the frequent terms' rows to every task, where whole arrays of words
add up to one row per text; only occurrences of rarer terms become rows and are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmark import settings
from textmark.functions.keys import in_share
from textmark.operators.lookup import least_frequent, lookup_join
from textmark.operators.tokens import words_only
from textmark.plans.learners import LearnerSpec, TrainedMember, checked_rows, labelled, parts
from textmark.runtime import written

# The number of a text; rows that have it are written.
ROW = "_text"

# Words that are looked up at once in a task; a longer text is looked up alone.
_WORDS_AT_ONCE = 1 << 20


def numbered(words: DataFrame, purpose: str = "prepared-words") -> DataFrame:
    """Rows numbered and written, once: a number that is made twice may differ."""
    return words if ROW in words.columns else written(words.withColumn(ROW, F.monotonically_increasing_id()), purpose)


def frequent_sums(texts: DataFrame, key: str, often: DataFrame, slots: int) -> DataFrame:
    """``(key, known, s0, s1, ..., rest)``: sums over the words in ``often(term, g0, g1, ...)``.

    ``often`` is sent to every task, where words are looked up by the array; ``rest`` are the
    words that it does not hold.
    """
    table = often.toArrow()
    terms = table.column("term").combine_chunks()
    gains = [table.column(f"g{i}").to_numpy() for i in range(slots)]
    shared = texts.sparkSession.sparkContext.broadcast((terms, gains))
    names = [key, "known", *[f"s{i}" for i in range(slots)], "rest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, gains = shared.value
        for batch in batches:
            length = pc.fill_null(pc.list_value_length(batch.column("words")), 0).to_numpy()
            ends, at = np.cumsum(length, dtype=np.int64), 0
            while at < len(length):
                before = ends[at] - length[at]
                end = max(at + 1, int(np.searchsorted(ends, before + _WORDS_AT_ONCE, side="right")))
                part, counts = batch.slice(at, end - at), length[at:end]
                words = part.column("words").flatten()
                place = pc.index_in(words, value_set=terms)
                found = place.is_valid().to_numpy(zero_copy_only=False)
                text = np.repeat(np.arange(len(counts)), counts)
                own, place = text[found], place.drop_null().to_numpy()
                # Without any word found the counts come as whole numbers.
                sums = [np.bincount(own, gain[place], len(counts)).astype(float, copy=False) for gain in gains]
                rest = np.zeros(len(counts) + 1, np.int32)
                np.cumsum(np.bincount(text[~found], minlength=len(counts)), out=rest[1:])
                columns = [
                    part.column(key),
                    pa.array(np.bincount(own, minlength=len(counts))),
                    *map(pa.array, sums),
                    pa.ListArray.from_arrays(pa.array(rest), words.filter(pa.array(~found))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at = end

    sums = ", ".join(f"s{i} double" for i in range(slots))
    schema = f"`{key}` {dict(texts.dtypes)[key]}, known long, {sums}, rest array<string>"
    return written(texts.select(key, "words").mapInArrow(run, schema), "frequent-sums")


@dataclass(frozen=True)
class Slot:
    """One label of one member: ``prior`` per text, ``each`` per known occurrence."""

    member: str
    label: float
    prior: float
    each: float


@dataclass(frozen=True)
class TermModel:
    """``weights(term, seen, g0, g1, ...)`` of all terms, one column per slot.

    ``seen`` counts the term's occurrences in the texts that the model knows.  Slots of a
    member follow each other, the most frequent label first, ties in the order of their
    names: of equal scores the first wins.
    """

    specs: tuple[LearnerSpec, ...]
    slots: tuple[Slot, ...]
    weights: DataFrame

    @cached_property
    def least_seen(self) -> int | None:
        """Terms that were seen so often are sent to every task; None: all are."""
        return least_frequent(self.weights, "seen")

    def sums(self, texts: DataFrame, key: str) -> DataFrame:
        """``(key, known, s0, s1, ...)`` over the ``words`` that the model knows.

        A small table is joined.  Else no row is made of a frequent term's occurrence, and no
        known term among the shuffled ones has many.
        """
        slots = range(len(self.slots))
        if self.least_seen is None:
            rows = words_only(texts, key, token="term")
            joined = lookup_join(rows, self.weights.drop("seen"), ["term"], "inner", [key])
            sums = [F.sum(f"g{i}").alias(f"s{i}") for i in slots]
            return joined.groupBy(key).agg(F.count("*").alias("known"), *sums)
        often = self.weights.where(F.col("seen") >= self.least_seen).drop("seen")
        seldom = self.weights.where(F.col("seen") < self.least_seen).drop("seen")
        found = frequent_sums(texts, key, often, len(self.slots))
        rest = words_only(found, key, words="rest", token="term").join(seldom, "term")
        rest = rest.select(key, F.lit(1).cast("long").alias("known"), *[F.col(f"g{i}").alias(f"s{i}") for i in slots])
        both = found.drop("rest").unionByName(rest)
        return both.groupBy(key).agg(F.sum("known").alias("known"), *[F.sum(f"s{i}").alias(f"s{i}") for i in slots])

    def score(self, i: int) -> Column:
        """Log score of slot i, of a row joined with ``sums``; no known term leaves the prior."""
        slot = self.slots[i]
        gain = F.coalesce(f"s{i}", F.lit(0.0)) + F.coalesce("known", F.lit(0)) * F.lit(slot.each)
        return gain + F.lit(slot.prior)

    def mark(self, member: str) -> Column:
        own = [i for i, slot in enumerate(self.slots) if slot.member == member]
        scores = F.array(*[self.score(i) for i in own])
        labels = F.array(*[F.lit(self.slots[i].label) for i in own])
        return F.element_at(labels, F.array_position(scores, F.array_max(scores)).cast("int"))

    def marked(self, words: DataFrame) -> DataFrame:
        """``words`` with one mark column per member; rows that share a key stay apart."""
        void = {name for name, kind in words.dtypes if kind == "void"}  # no file holds them
        texts = numbered(words.drop(*void))
        marks = [self.mark(spec.member).alias(spec.mark_column) for spec in self.specs]
        columns = [F.lit(None).alias(name) if name in void else F.col(name) for name in words.columns]
        return texts.join(self.sums(texts, ROW), ROW, "left").select(*columns, *marks)

    def scores(self, words: DataFrame, key: str) -> DataFrame:
        """``(key, member, label, score)`` for every text and label; keys are unique."""
        texts = numbered(words.select(key, "words", *[name for name in words.columns if name == ROW]))
        rows = texts.select(key).join(self.sums(texts, key), key, "left")
        entries = [
            F.struct(F.lit(slot.member).alias("member"), F.lit(slot.label).alias("label"), self.score(i).alias("score"))
            for i, slot in enumerate(self.slots)
        ]
        return rows.select(key, F.inline(F.array(*entries)))

    def save(self, path: str) -> None:
        spark = self.weights.sparkSession
        self.weights.write.mode("overwrite").parquet(f"{path}/weights")
        rows = [(x.member, x.label, x.prior, x.each) for x in self.slots]
        slots = spark.createDataFrame(rows, "member string, label double, prior double, each double")
        numbered = slots.withColumn("i", F.monotonically_increasing_id())
        numbered.coalesce(1).write.mode("overwrite").parquet(f"{path}/slots")

    @classmethod
    def load(cls, spark: SparkSession, path: str, specs: Sequence[LearnerSpec]) -> "TermModel":
        rows = spark.read.parquet(f"{path}/slots").orderBy("i").drop("i").collect()
        return cls(tuple(specs), tuple(Slot(*x) for x in rows), spark.read.parquet(f"{path}/weights"))


def scope(key: str, specs: Sequence[LearnerSpec], fit_scope: str) -> Column:
    """Rows whose terms the model knows: those that some member is fitted on, or all."""
    if fit_scope == "all" or not all(spec.holdout for spec in specs):
        return F.lit(True)
    if fit_scope != "train":
        raise ValueError(f"fit_scope is 'train' or 'all', not {fit_scope!r}")
    salts = sorted({spec.salt for spec in specs})
    return reduce(lambda a, b: a | b, [in_share(F.col(key), settings.TRAIN_SHARE, salt) for salt in salts])


def fit_terms(
    words: DataFrame,
    specs: Sequence[LearnerSpec],
    key: str = "doc_id",
    mark: str = "rating",
    fit_scope: str = "train",
    tested: bool = True,
) -> tuple[TermModel, list[TrainedMember]]:
    """All naive Bayes members at once from ``(key, mark, words)``; keys are unique.

    ``words`` are read several times: written rows.  The members come without a model of
    their own and, if ``tested``, with their scored test rows, written.
    """
    truth = words.select(key, mark)
    fits, tests = zip(*(parts(labelled(truth, spec, key, mark), spec, key) for spec in specs), strict=True)
    # Balanced classes take shuffles; all other fitted rows are a filter.
    fits = [rows if spec.target is None else written(rows, "fitted-rows") for rows, spec in zip(fits, specs, strict=True)]
    for rows, spec in zip(fits, specs, strict=True):
        checked_rows(rows, spec)
    member = lambda i: fits[i].select(key, F.lit(i).alias("member"), "label")
    # At most ten labels a member, which checked_rows saw to.
    sizes = reduce(DataFrame.union, map(member, range(len(specs)))).groupBy("member", "label")
    order = sorted(sizes.agg(F.count("*").alias("n")).collect(), key=lambda x: (x["member"], -x["n"], str(x["label"])))

    known, side = words.where(scope(key, specs, fit_scope)), {}
    for i, spec in enumerate(specs):
        if spec.target is None:
            own = in_share(F.col(key), settings.TRAIN_SHARE, spec.salt) if spec.holdout else F.lit(True)
            side[i] = F.when(own, F.col(mark).cast("double")).alias(f"l{i}")
        else:
            known = known.join(fits[i].select(key, F.col("label").alias(f"l{i}")), key, "left")
            side[i] = F.col(f"l{i}")
    occurrences = words_only(known.select("words", *side.values()), *[f"l{i}" for i in side], token="term")
    counted = [F.count_if(F.col(f"l{x['member']}") == x["label"]).cast("double").alias(f"c{i}") for i, x in enumerate(order)]
    counts = written(occurrences.groupBy("term").agg(F.count("*").alias("seen"), *counted), "term-counts")
    total = counts.agg(F.count("*").alias("terms"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(order))]).first()
    smooth = settings.BAYES_SMOOTHING
    slots = []
    for i, x in enumerate(order):
        rows = [y["n"] for y in order if y["member"] == x["member"]]
        prior = math.log(x["n"] + smooth) - math.log(sum(rows) + len(rows) * smooth)
        each = math.log(smooth) - math.log((total[f"c{i}"] or 0.0) + max(1, total["terms"]) * smooth)
        slots.append(Slot(specs[x["member"]].member, float(x["label"]), prior, each))
    gains = [(F.log(F.col(f"c{i}") + F.lit(smooth)) - F.lit(math.log(smooth))).alias(f"g{i}") for i in range(len(order))]
    model = TermModel(tuple(specs), tuple(slots), counts.select("term", "seen", *gains))
    if not tested:
        return model, [TrainedMember(spec, None) for spec in specs]

    apart = [~in_share(F.col(key), settings.TRAIN_SHARE, spec.salt) if spec.holdout else F.lit(True) for spec in specs]
    texts = words.where(reduce(lambda a, b: a | b, apart))
    marks = texts.select(key).join(model.sums(texts, key), key, "left")
    marks = written(marks.select(key, *[model.mark(spec.member).alias(spec.mark_column) for spec in specs]), "member-marks")
    members = []
    for spec, rows in zip(specs, tests, strict=True):
        mark_of = marks.select(key, F.col(spec.mark_column).alias("prediction"))
        members.append(TrainedMember(spec, None, rows.select(key, "label").join(mark_of, key)))
    return model, members
