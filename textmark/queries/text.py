"""Cleaning, tokens, stems, stop words."""

from pyspark.sql import functions as F

from textmark.functions import text as T
from textmark.operators import tokens as W
from textmark.operators.sampling import drop_incomplete
from textmark.queries import sql as S
from textmark.queries.registry import query
from textmark.sources import tables, words


def prepared_documents(spark, folder):
    """``(doc_id, words)`` of all documents, with the sample word lists."""
    return W.prepare_words(
        tables.documents(spark, folder),
        "doc_id",
        lemmas=words.sample_lemma_map(),
        stop_words=words.SAMPLE_STOP_WORDS,
    )


@query(
    "load_reviews",
    f"SELECT doc_id, rating, length(text) AS n_chars FROM ({S.QUALITY_RATED}) "
    "WHERE rating IS NOT NULL AND text IS NOT NULL",
)
def load_reviews(spark, folder):
    reviews = drop_incomplete(tables.quality_rated(spark, folder), "rating", "text")
    return reviews.select("doc_id", "rating", F.length("text").cast("long").alias("n_chars"))


@query("raw_tokens", f"WITH {S.token_rows()} SELECT doc_id, pos, token FROM raw")
def raw_tokens(spark, folder):
    found = T.raw_tokens(F.col("text")).alias("words")
    return W.word_rows(tables.documents(spark, folder).select("doc_id", found), "doc_id")


@query("tokenize", f"WITH {S.token_rows()} SELECT doc_id, pos, token FROM tokens")
def tokenize(spark, folder):
    return W.token_rows(tables.documents(spark, folder), "doc_id")


@query(
    "label_term_counts",
    f"WITH rated AS ({S.LANGUAGE_RATED}), {S.token_rows()} SELECT rating, token, count(*) AS n "
    "FROM tokens JOIN rated USING (doc_id) WHERE rating IS NOT NULL GROUP BY rating, token",
)
def label_term_counts(spark, folder):
    reviews = drop_incomplete(tables.language_rated(spark, folder), "rating", "text")
    found = W.words_only(
        reviews.select("rating", T.raw_tokens(F.col("text")).alias("words")), "rating"
    )
    return found.groupBy("rating", F.lower("token").alias("token")).agg(F.count("*").alias("n"))


@query(
    "lemmatize",
    f"WITH {S.token_rows()}, {S.LEMMA} SELECT t.doc_id, t.pos, coalesce(l.stem, t.token) AS stem "
    "FROM tokens t LEFT JOIN lemma l ON l.token = t.token AND l.rnk = 1",
)
def lemmatize(spark, folder):
    rows = W.token_rows(tables.documents(spark, folder), "doc_id")
    stemmed = W.attach_stems(rows, words.sample_lemmas(spark), "doc_id")
    return stemmed.select("doc_id", "pos", "stem")


@query(
    "stopword_filter",
    f"WITH {S.token_rows()}, {S.STOP} SELECT doc_id, pos, token FROM tokens "
    "WHERE token NOT IN (SELECT word FROM stop)",
)
def stopword_filter(spark, folder):
    rows = W.token_rows(tables.documents(spark, folder), "doc_id")
    return W.drop_stop_rows(rows, words.sample_stop_words(spark), "doc_id", "token")


_PREPARED = f"""WITH {S.word_rows()}
SELECT d.doc_id, count(w.word) AS n_words,
       coalesce(string_agg(w.word, ' ' ORDER BY w.pos), '') AS words
FROM documents d LEFT JOIN words w ON w.doc_id = d.doc_id GROUP BY d.doc_id"""


def _joined_words(prepared):
    return prepared.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.array_join("words", " ").alias("words"),
    )


@query("prepare_text", _PREPARED)
def prepare_text(spark, folder):
    return _joined_words(prepared_documents(spark, folder))


@query("prepare_text_with_tables", _PREPARED)
def prepare_text_with_tables(spark, folder):
    return _joined_words(
        W.prepare_words(
            tables.documents(spark, folder),
            "doc_id",
            lemmas=words.sample_lemmas(spark),
            stop_words=words.sample_stop_words(spark),
        )
    )


@query(
    "prepare_text_token_filter",
    f"""WITH {S.token_rows()}, {S.STOP}, {S.LEMMA}
SELECT t.doc_id, coalesce(l.stem, t.token) AS word, count(*) AS n
FROM tokens t LEFT JOIN lemma l ON l.token = t.token AND l.rnk = 1
WHERE t.token NOT IN (SELECT word FROM stop) GROUP BY ALL""",
)
def prepare_text_token_filter(spark, folder):
    prepared = W.prepare_words(
        tables.documents(spark, folder),
        "doc_id",
        lemmas=words.sample_lemma_map(),
        stop_words=words.SAMPLE_STOP_WORDS,
        filter_on="token",
    )
    rows = W.words_only(prepared, "doc_id", token="word")
    return rows.groupBy("doc_id", "word").agg(F.count("*").alias("n"))


@query("text_length", "SELECT doc_id, length(text)::INTEGER AS n_chars FROM documents")
def text_length(spark, folder):
    documents = tables.table(spark, folder, "documents")
    return documents.select("doc_id", T.text_length(F.col("text")).alias("n_chars"))


@query("fingerprint", "SELECT doc_id, md5(text) AS fingerprint FROM documents")
def fingerprint(spark, folder):
    documents = tables.table(spark, folder, "documents")
    return documents.select("doc_id", T.fingerprint(F.col("text")).alias("fingerprint"))


@query(
    "parse_rating",
    r"""SELECT event_id, try_cast(regexp_extract(props, ':\s*([^}]*)', 1) AS DOUBLE) AS rating,
               try_cast(event_type AS DOUBLE) AS no_rating FROM events""",
)
def parse_rating(spark, folder):
    return tables.table(spark, folder, "events").select(
        "event_id",
        T.parsed_rating(F.regexp_extract("props", r":\s*([^}]*)", 1)).alias("rating"),
        T.parsed_rating(F.col("event_type")).alias("no_rating"),
    )
