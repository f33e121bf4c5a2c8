"""Vocabulary, count vectors and TF-IDF.

Vectors are built by Spark ML inside the tasks: once the vocabulary is known, a
text becomes a vector without a shuffle, and a vector becomes rows without one.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    HashingTF,
    IDFModel,
    IndexToString,
    StringIndexer,
    VectorIndexer,
)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmark.operators.lookup import frequent_join, least_frequent, lookup_join
from textmark.operators.ranking import row_index
from textmark.operators.tokens import words_only
from textmark.runtime import cut_lineage, written
from textmark.settings import HASH_BUCKETS, TOP_K_ROWS, TREE_MAX_CATEGORIES, VOCABULARY_SIZE

log = logging.getLogger(__name__)


def term_counts(df: DataFrame, words: str = "words") -> DataFrame:
    """Corpus count of every term; hot terms combine before the shuffle."""
    exploded = words_only(df, words=words, token="term")
    return exploded.groupBy("term").agg(F.count("*").alias("n"))


def bag_of_words(df: DataFrame, key: str, words: str = "words") -> DataFrame:
    """``(key, term, n)`` for every term of every text; no vocabulary is needed.

    The texts' words are dealt by key while they are arrays; no word is shuffled alone.
    """
    exploded = words_only(df.select(key, words).repartition(key), key, words=words, token="term")
    return exploded.groupBy(key, "term").agg(F.count("*").cast("double").alias("n"))


def document_frequencies(bag: DataFrame) -> DataFrame:
    """``(term, texts)``: in how many texts each term stands."""
    return bag.groupBy("term").agg(F.count("*").alias("texts"))


def tfidf(bag: DataFrame, key: str, texts: int) -> DataFrame:
    """``(key, term, weight)``: counts times ``ln((texts + 1) / (texts with the term + 1))``.

    Frequent terms' weights are sent to the counts, only counts of rarer terms are shuffled.
    ``bag`` is read several times: written rows.
    """
    seen = written(document_frequencies(bag), "document-frequencies")
    idf = seen.withColumn("idf", F.log(F.lit(texts + 1.0) / (F.col("texts") + 1)))
    least = least_frequent(idf, "texts")
    if least is None:
        joined = lookup_join(bag, idf.drop("texts"), ["term"], "inner", [key])
    else:
        joined = frequent_join(bag, idf, "term", "texts", least)
    return joined.select(key, "term", (F.col("n") * F.col("idf")).alias("weight"))


def category_codes(bag: DataFrame, texts: int) -> DataFrame:
    """``(term, value, category)`` of the terms whose counts take at most four values.

    A text without the term counts as value 0.  Zero keeps code 0, as sparse vectors
    need it; the other values follow in order.  Terms with more values drop out after
    their distinct values were counted, so no term gathers more than four rows.
    """
    seen = bag.groupBy("term", F.col("n").alias("value")).agg(F.count("*").alias("texts"))
    held = F.sum("texts").alias("held")
    terms = seen.groupBy("term").agg(F.count("*").alias("values"), held)
    absent = F.col("held") < texts
    terms = terms.withColumn("absent", absent).where(
        F.col("values") + absent.cast("long") <= TREE_MAX_CATEGORIES
    )
    zero = terms.where("absent").select("term", F.lit(0.0).alias("value"))
    kept = seen.join(terms.select("term"), "term", "left_semi").select("term", "value").union(zero)
    code = F.row_number().over(Window.partitionBy("term").orderBy("value")) - 1
    return kept.select("term", "value", code.cast("long").alias("category"))


def vocabulary(df: DataFrame, size: int | None = None, words: str = "words") -> DataFrame:
    """``(index, term, n)``: all terms, or the most frequent ones, ties in term order.

    The order is total, so the same corpus always gives the same indices.  The
    table is computed here, once, and read back from the shared folder.  With a size,
    terms rarer than any wanted one are dropped by count before the sort, and the number
    of terms beyond the size is logged.
    """
    counts = term_counts(df, words)
    order = [F.desc("n"), F.asc("term")]
    if size is not None:
        counts = written(counts, "term-counts")
        terms = counts.count()
        if terms > size:
            log.warning("%d of %d terms are beyond the vocabulary size %d", terms - size, terms, size)
        counts = counts.where(F.col("n") >= least_count(counts, size))
    if size is None:
        return row_index(counts, order, "_row").select(F.col("_row").cast("int").alias("index"), "term", "n")
    if size <= TOP_K_ROWS:
        top = counts.orderBy(*order).limit(size)
        number = F.row_number().over(Window.orderBy(*order)) - 1
        return cut_lineage(top.select(number.cast("int").alias("index"), "term", "n"))
    numbered = row_index(counts, order, "_row").where(F.col("_row") < size)
    return numbered.select(F.col("_row").cast("int").alias("index"), "term", "n")


def least_count(counts: DataFrame, size: int) -> int:
    """A count that at least ``size`` terms reach, as high as powers of two tell."""
    steps = counts.groupBy(F.floor(F.log2("n")).alias("step")).agg(F.count("*").alias("terms"))
    so_far = 0
    for row in sorted(steps.collect(), key=lambda row: -row["step"]):
        so_far += row["terms"]
        if so_far >= size:
            return 1 << int(row["step"])
    return 1


def term_list(terms: DataFrame) -> list[str]:
    """The terms in index order, on the driver.

    Every fitted vectoriser holds them there; their number is the vocabulary size.
    """
    table = terms.select("index", "term").toArrow().sort_by("index")
    return table.column("term").to_pylist()


def vectoriser(
    listed: Sequence[str], words: str = "words", features: str = "features"
) -> CountVectorizerModel:
    """Count vectoriser over a list of terms."""
    if not listed:
        raise ValueError("no term in any text")
    if len(listed) <= 1000 or any("\n" in term for term in listed):
        return CountVectorizerModel.from_vocabulary(list(listed), words, features)
    # from_vocabulary copies term by term through the gateway; one joined string
    # crosses it at once.
    jvm = SparkSession.getActiveSession()._jvm
    joined = jvm.java.util.regex.Pattern.compile("\n").split("\n".join(listed))
    model = CountVectorizerModel._create_from_java_class(
        "org.apache.spark.ml.feature.CountVectorizerModel", joined
    )
    return model.setInputCol(words).setOutputCol(features)


def vector_rows(df: DataFrame, keys: Sequence[str], features: str = "features") -> DataFrame:
    """Non-zero entries of sparse vectors as ``(keys, index, value)`` rows."""
    inner = F.unwrap_udt(features)
    entries = F.arrays_zip(inner["indices"].alias("index"), inner["values"].alias("value"))
    rows = df.select(*keys, F.explode_outer(entries).alias("_e"))
    return rows.where(F.col("_e").isNotNull()).select(*keys, "_e.index", "_e.value")


def with_terms(rows: DataFrame, terms: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the term of every ``index``."""
    named = terms.select("index", "term")
    return lookup_join(rows, named, ["index"], "inner", keys, VOCABULARY_SIZE)


def inverse_document_frequency(
    df: DataFrame, features: str = "features", weighted: str = "weighted"
) -> IDFModel:
    """Fit ``ln((texts + 1) / (texts with the term + 1))`` per vector position."""
    return IDF(inputCol=features, outputCol=weighted, minDocFreq=0).fit(df)


def hashed_counts(
    words: str = "words", features: str = "raw_features", buckets: int = HASH_BUCKETS
) -> HashingTF:
    return HashingTF(inputCol=words, outputCol=features, numFeatures=buckets)


def fit_counts(
    df: DataFrame, size: int = VOCABULARY_SIZE, words: str = "words", features: str = "features"
) -> PipelineModel:
    """Extractor of count vectors over the vocabulary of ``df``."""
    listed = term_list(vocabulary(df, size, words))
    return PipelineModel([vectoriser(listed, words, features)])


def fit_hashed_counts(
    df: DataFrame, size: int = HASH_BUCKETS, words: str = "words", features: str = "features"
) -> PipelineModel:
    """Extractor of hashed counts: every term has a place, however few places there are."""
    return PipelineModel([hashed_counts(words, features, size)])


def fit_hashed_tfidf(
    df: DataFrame, size: int = HASH_BUCKETS, words: str = "words", features: str = "features"
) -> PipelineModel:
    """Extractor of hashed counts weighted by the IDF of ``df``."""
    raw = f"raw_{features}"
    idf = IDF(inputCol=raw, outputCol=features, minDocFreq=0)
    return Pipeline(stages=[hashed_counts(words, raw, size), idf]).fit(df.select(words))


EXTRACTORS = {
    "counts": fit_counts,
    "hashed_counts": fit_hashed_counts,
    "hashed_tfidf": fit_hashed_tfidf,
}


def fit_extractor(kind: str, df: DataFrame, size: int, features: str = "features") -> PipelineModel:
    """A fitted extractor; ``extract`` applies it to these or any other words."""
    if kind not in EXTRACTORS:
        raise ValueError(f"no extractor {kind!r}; there are {sorted(EXTRACTORS)}")
    return EXTRACTORS[kind](df, size, features=features)


def extract(model: PipelineModel, df: DataFrame, *features: str) -> DataFrame:
    """``df`` with its vectors, one column or several; intermediate columns drop."""
    return model.transform(df).select(*df.columns, *(features or ("features",)))


def label_indexer(label: str = "label", indexed: str = "indexed_label") -> StringIndexer:
    """Labels by frequency, ties in label order."""
    return StringIndexer(inputCol=label, outputCol=indexed, stringOrderType="frequencyDesc")


def label_names(labels: Sequence[str], prediction: str, output: str) -> IndexToString:
    return IndexToString(inputCol=prediction, outputCol=output, labels=list(labels))


def category_indexer(
    features: str = "features", indexed: str = "indexed_features"
) -> VectorIndexer:
    """Features with at most four values are categories; new values get their own."""
    return VectorIndexer(
        inputCol=features,
        outputCol=indexed,
        maxCategories=TREE_MAX_CATEGORIES,
        handleInvalid="keep",
    )


def vector_width(df: DataFrame, features: str = "features") -> int:
    """Length of the vectors, read from the first one (any kind of vector)."""
    first = df.select(features).first()
    if first is None:
        raise ValueError("no row to read the vector width from")
    return first[features].size
