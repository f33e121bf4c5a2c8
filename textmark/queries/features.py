"""Vocabulary, counts per text, TF-IDF, indexers."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from textmark.operators import features as V
from textmark.queries import sql as S
from textmark.queries.registry import query
from textmark.queries.text import prepared_documents
from textmark.runtime import written
from textmark.settings import HASH_BUCKETS, TREE_MAX_CATEGORIES
from textmark.sources import tables

_TERMS = "SELECT word AS term, count(*) AS n FROM words GROUP BY word"


def _vocabulary_sql(size=None):
    return f"""vocabulary AS (
        SELECT term, n, (row_number() OVER (ORDER BY n DESC, term) - 1)::INTEGER AS index
        FROM ({_TERMS}) ORDER BY n DESC, term {"" if size is None else f"LIMIT {size}"})"""


_COUNTS = """counts AS (SELECT doc_id, word AS term, count(*)::DOUBLE AS n
    FROM words GROUP BY doc_id, word)"""


@query("term_counts", f"WITH {S.word_rows()} {_TERMS}")
def term_counts(spark, folder):
    return V.term_counts(prepared_documents(spark, folder))


@query(
    "vocabulary",
    f"WITH {S.word_rows()}, {_vocabulary_sql()} SELECT index, term, n FROM vocabulary",
)
def vocabulary(spark, folder):
    return V.vocabulary(prepared_documents(spark, folder))


@query(
    "vocabulary_top",
    f"WITH {S.word_rows()}, {_vocabulary_sql(500)} SELECT index, term, n FROM vocabulary",
)
def vocabulary_top(spark, folder):
    return V.vocabulary(prepared_documents(spark, folder), 500)


def _bag(spark, folder):
    return V.bag_of_words(prepared_documents(spark, folder), "doc_id")


@query("bag_of_words", f"WITH {S.word_rows()}, {_COUNTS} SELECT doc_id, term, n FROM counts")
def bag_of_words(spark, folder):
    return _bag(spark, folder)


@query(
    "count_vector_stats",
    f"""WITH {S.word_rows()}, {_COUNTS}
    SELECT d.doc_id, count(c.term)::INTEGER AS n_terms, coalesce(sum(c.n), 0)::DOUBLE AS n_words,
           (SELECT count(DISTINCT word) FROM words)::INTEGER AS width
    FROM documents d LEFT JOIN counts c ON c.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def count_vector_stats(spark, folder):
    """Entries, sum and width of every text's count vector, over all terms."""
    prepared = prepared_documents(spark, folder)
    width = V.term_counts(prepared).agg(F.count("*").cast("int").alias("width"))
    stats = prepared.select(
        "doc_id",
        F.size(F.array_distinct("words")).alias("n_terms"),
        F.size("words").cast("double").alias("n_words"),
    )
    return stats.crossJoin(F.broadcast(width))


@query(
    "tfidf",
    f"""WITH {S.word_rows()}, {_COUNTS},
    spread AS (SELECT term, count(*) AS df FROM counts GROUP BY term)
    SELECT doc_id, term, round(n * ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (df + 1)), 6)
           AS weight
    FROM counts JOIN spread USING (term)""",
)
def tfidf(spark, folder):
    bag = written(_bag(spark, folder), "bag-of-words")
    texts = tables.table(spark, folder, "documents").count()
    return V.tfidf(bag, "doc_id", texts).withColumn("weight", F.round("weight", 6))


_HASHED = f"""{S.word_rows()}, {_COUNTS}, {S.hashed_places("SELECT DISTINCT word AS term FROM words", HASH_BUCKETS)},
    hashed AS (SELECT doc_id, bucket::INTEGER AS bucket, sum(n)::DOUBLE AS n
        FROM counts JOIN murmur USING (term) GROUP BY doc_id, bucket)"""


@query("hashing_tf", f"WITH {_HASHED} SELECT doc_id, bucket, n FROM hashed")
def hashing_tf(spark, folder):
    """``(doc_id, bucket, n)``; the buckets are Spark's own hash."""
    hashed = V.hashed_counts().transform(prepared_documents(spark, folder))
    return V.vector_rows(hashed, ["doc_id"], "raw_features").select(
        "doc_id", F.col("index").alias("bucket"), F.col("value").alias("n")
    )


@query(
    "hashing_tf_totals",
    f"""WITH {S.word_rows()} SELECT d.doc_id, count(w.word)::DOUBLE AS n_words
    FROM documents d LEFT JOIN words w ON w.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def hashing_tf_totals(spark, folder):
    hashed = V.hashed_counts().transform(prepared_documents(spark, folder))
    values = F.unwrap_udt("raw_features")["values"]
    total = F.aggregate(values, F.lit(0.0), lambda total, value: total + value)
    return hashed.select("doc_id", total.alias("n_words"))


@query(
    "hashed_tfidf",
    f"""WITH {_HASHED},
    spread AS (SELECT bucket, count(*) AS df FROM hashed GROUP BY bucket)
    SELECT doc_id, bucket, round(n * ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (df + 1)), 6) AS weight
    FROM hashed JOIN spread USING (bucket)""",
)
def hashed_tfidf(spark, folder):
    """``(doc_id, bucket, weight)``: hashed counts weighted by their own IDF."""
    prepared = prepared_documents(spark, folder)
    vectors = V.extract(V.fit_hashed_tfidf(prepared), prepared)
    return V.vector_rows(vectors, ["doc_id"]).select(
        "doc_id", F.col("index").alias("bucket"), F.round("value", 6).alias("weight")
    )


@query(
    "hashing_tf_texts",
    f"""WITH {S.word_rows()}, {_COUNTS}
    SELECT doc_id, sum(n) AS n_words, TRUE AS within_terms, TRUE AS weighted FROM counts GROUP BY doc_id""",
)
def hashing_tf_texts(spark, folder):
    """Per text: words in all buckets, no more buckets than terms, and a weight for each."""
    prepared = prepared_documents(spark, folder)
    hashed = V.hashed_counts().transform(prepared)
    terms = F.size(F.array_distinct("words")).alias("terms")
    # Texts are prepared once; all figures of a text come from its own vectors.
    hashed = written(hashed.select("doc_id", "raw_features", terms), "hashed-texts")
    idf = V.inverse_document_frequency(hashed, "raw_features")
    counts, weights = F.unwrap_udt("raw_features"), F.unwrap_udt("weighted")
    texts = idf.transform(hashed).select(
        "doc_id", "terms",
        F.aggregate(counts["values"], F.lit(0.0), lambda total, value: total + value).alias("n_words"),
        F.size(counts["indices"]).alias("buckets"), F.size(weights["indices"]).alias("weights"),
        F.array_min(F.transform(weights["values"], lambda weight: F.round(weight, 6))).alias("least"),
    )
    return texts.where("buckets > 0").select(
        "doc_id", "n_words", (F.col("buckets") <= F.col("terms")).alias("within_terms"),
        ((F.col("weights") == F.col("buckets")) & (F.col("least") >= 0)).alias("weighted"),
    )


@query(
    "vector_conversion",
    """SELECT vec_id, (i - 1)::INTEGER AS pos, embedding[i]::DOUBLE AS value FROM (
        SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
)
def vector_conversion(spark, folder):
    vectors = tables.embedding_marks(spark, folder)
    values = F.posexplode(vector_to_array("features")).alias("pos", "value")
    return vectors.select("vec_id", values)


_LABEL_INDEX = """SELECT lang, (row_number() OVER (ORDER BY count(*) DESC, lang) - 1)::DOUBLE AS index
    FROM documents WHERE lang IS NOT NULL GROUP BY lang"""


@query(
    "string_index",
    f"SELECT doc_id, lang, index FROM documents JOIN ({_LABEL_INDEX}) USING (lang)",
)
def string_index(spark, folder):
    languages = tables.table(spark, folder, "documents").select("doc_id", "lang").dropna()
    indexed = V.label_indexer("lang", "index").fit(languages).transform(languages)
    return indexed.select("doc_id", "lang", "index")


@query(
    "index_to_string",
    """SELECT vec_id, (label + 1)::DOUBLE::VARCHAR AS mark_name FROM embeddings""",
)
def index_to_string(spark, folder):
    marks = tables.embedding_marks(spark, folder).select("vec_id", "rating")
    index = V.label_indexer("rating", "index").fit(marks)
    named = V.label_names(index.labels, "index", "mark_name").transform(index.transform(marks))
    return named.select("vec_id", "mark_name")


@query(
    "vector_index",
    f"""WITH {S.word_rows()}, {_COUNTS},
    seen AS (SELECT term, n FROM counts
             UNION SELECT term, 0 FROM counts GROUP BY term
             HAVING count(*) < (SELECT count(*) FROM documents))
    SELECT s.term, s.n AS value, row_number() OVER (PARTITION BY s.term ORDER BY s.n <> 0, s.n) - 1
           AS category
    FROM seen s
    WHERE s.term IN (SELECT term FROM seen GROUP BY term HAVING count(*) <= {TREE_MAX_CATEGORIES})""",
)
def vector_index(spark, folder):
    """Which terms are categories, and the codes of their values, over all terms."""
    bag = written(_bag(spark, folder), "bag-of-words")
    return V.category_codes(bag, tables.table(spark, folder, "documents").count())


@query("feature_count", f"WITH {S.word_rows()} SELECT count(DISTINCT word) AS n_features FROM words")
def feature_count(spark, folder):
    return V.term_counts(prepared_documents(spark, folder)).agg(F.count("*").alias("n_features"))
