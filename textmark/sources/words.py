"""Word lists: stop words, lemma tables, and small samples of both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmark.settings import LITERAL_ENTRIES


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lines of a text file as ``(word)``."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def read_lemmas(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``token, rank, stem`` lines; rank 1 is the first candidate."""
    return spark.read.csv(path, schema="token string, rank int, stem string", sep="\t")


def small_word_set(words: DataFrame) -> frozenset[str] | DataFrame:
    """The words as a Python set when they fit a literal, else the table itself."""
    rows = words.select("word").limit(LITERAL_ENTRIES + 1).collect()
    return words if len(rows) > LITERAL_ENTRIES else frozenset(row["word"] for row in rows)


# Sample lists for the bundled queries; real ones are files given by the user.
SAMPLE_STOP_WORDS = tuple(
    "the of and to a in is that for it be der die und das de la le et un el los y".split()
)
SAMPLE_LEMMAS = (
    ("are", 1, "be"),
    ("was", 1, "be"),
    ("was", 2, "what"),
    ("les", 1, "le"),
    ("des", 1, "de"),
    ("une", 1, "un"),
    ("las", 1, "la"),
    ("den", 1, "der"),
    ("dem", 2, "das"),
    ("dem", 1, "der"),
    ("eine", 1, "ein"),
    ("est", 1, "être"),
    ("the", 1, "this"),
    ("con", 1, "con"),
)


def sample_lemma_map() -> dict[str, str]:
    """First candidates of the sample lemmas."""
    return {token: stem for token, rank, stem in SAMPLE_LEMMAS if rank == 1}


def sample_lemmas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SAMPLE_LEMMAS), "token string, rank int, stem string")


def sample_stop_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(word,) for word in SAMPLE_STOP_WORDS], "word string")
