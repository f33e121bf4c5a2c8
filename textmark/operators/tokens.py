"""Token rows (key, pos, token) and word arrays per text.

With word lists that fit a literal, ``prepare_words`` is a projection: no
shuffle, the text column ends there.  With larger lists the texts are first
hashed by key, once and still compact; exploding, looking up and gathering then
stay inside their partitions.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmark.functions import text as T
from textmark.operators.lookup import fits_broadcast, lookup_join
from textmark.runtime import written
from textmark.settings import LITERAL_ENTRIES


# Exploding with an inner explode makes the optimiser test the array for emptiness
# before it is built, which computes it twice; the outer form does not, and the
# one NULL row of an empty text is filtered afterwards.


def word_rows(df: DataFrame, key: str, words: str = "words", token: str = "token") -> DataFrame:
    """One row per word, positions from 0."""
    rows = df.select(key, F.posexplode_outer(words).alias("pos", token))
    return rows.where(F.col(token).isNotNull())


def words_only(df: DataFrame, *others: str, words: str = "words", token: str = "token") -> DataFrame:
    """One row per word without its position, beside the ``others`` columns."""
    rows = df.select(*others, F.explode_outer(words).alias(token))
    return rows.where(F.col(token).isNotNull())


def token_rows(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row per lower-cased token."""
    raw = word_rows(df.select(key, T.raw_tokens(F.col(text)).alias("words")), key)
    return raw.withColumn("token", F.lower("token"))


def first_stems(lemmas: DataFrame) -> DataFrame:
    """The best-ranked stem of every token of a ``(token, rank, stem)`` table."""
    return lemmas.groupBy("token").agg(F.min_by("stem", F.struct("rank", "stem")).alias("stem"))


def attach_stems(rows: DataFrame, lemmas: DataFrame, key: str) -> DataFrame:
    """Add the stem of every token; a token without one is its own stem.

    A dictionary too large to broadcast is first cut down to the words that the corpus
    holds, which are counted map-side; token rows are shuffled only if those are too many.
    """
    known = first_stems(lemmas).where("stem <> token")
    if not fits_broadcast(known):
        seen = rows.select("token").distinct()
        known = written(known.join(seen, "token", "left_semi"), "lemmas-in-use")
    joined = lookup_join(rows, known, ["token"], "left", [key, "pos"])
    return joined.withColumn("stem", F.coalesce("stem", "token"))


def drop_stop_rows(rows: DataFrame, stop_words: DataFrame, key: str, word: str = "stem") -> DataFrame:
    """Rows whose word is not in the ``word`` column of ``stop_words``."""
    listed = stop_words.select(F.col("word").alias(word)).distinct()
    return lookup_join(rows, listed, [word], "left_anti", [key, "pos"])


def prepare_words(
    df: DataFrame,
    key: str,
    text: str = "text",
    lemmas: Mapping[str, str] | DataFrame | None = None,
    stop_words: Collection[str] | DataFrame | None = None,
    filter_on: str = "stem",
) -> DataFrame:
    """Replace ``text`` by the array ``words``: tokens, stems, no stop words.

    Texts without a word left keep their row, with an empty array.  Lists that are
    too long for a literal become tables and take the join.
    """
    if any(needs_table(words) for words in (lemmas, stop_words)):
        return _prepare_by_join(df, key, text, lemmas, stop_words, filter_on)
    words = T.prepared(F.col(text), lemmas or {}, stop_words or (), filter_on)
    return df.withColumn("words", words).drop(text)


def needs_table(words: Mapping | Collection | DataFrame | None) -> bool:
    """Whether a word list is a table, or too long to be a literal."""
    return words is not None and (isinstance(words, DataFrame) or len(words) > LITERAL_ENTRIES)


def _prepare_by_join(df, key, text, lemmas, stop_words, filter_on) -> DataFrame:
    spark = df.sparkSession
    if lemmas is None or isinstance(lemmas, Mapping):
        rows = [(token, 1, stem) for token, stem in (lemmas or {}).items()]
        lemmas = spark.createDataFrame(rows, "token string, rank int, stem string")
    if not isinstance(stop_words, DataFrame):
        rows = [(word,) for word in (stop_words or ())]
        stop_words = spark.createDataFrame(rows, "word string")
    # Words are gathered by row, so rows that share a key stay apart.
    row = "_row"
    texts = df.withColumn(row, F.monotonically_increasing_id()).repartition(row)
    words = attach_stems(token_rows(texts, row, text), lemmas, row)
    kept = drop_stop_rows(words, stop_words, row, "stem" if filter_on == "stem" else "token")
    # One group is one text, which fitted a row before.
    gathered = kept.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("pos", "stem"))).alias("w"))
    arrays = gathered.select(row, F.col("w.stem").alias("words"))
    joined = texts.drop(text).join(arrays, row, "left").drop(row)
    return joined.withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
