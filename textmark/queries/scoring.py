"""Scoring a table, one text, and a stream."""

from pyspark.sql import functions as F

from textmark.operators.metrics import error_report
from textmark.plans.scoring import beside_truth, one_text, score_table, score_words
from textmark.queries import sql as S
from textmark.queries.ensemble import MEMBERS, SPECS
from textmark.queries.learners import text_scorer, words_and_scorer
from textmark.queries.registry import query
from textmark.runtime import work_folder
from textmark.sources import tables
from textmark.streaming.scoring import score_stream

_ONE_TEXT = "The film was good and the story is for all, but it was long."


def _scorer(spark, folder):
    return text_scorer(tables.language_rated(spark, folder), SPECS, tested=False)


_BAYES = S.bayes(S.LANGUAGE_RATED, MEMBERS)
_VOTED = S.vote("SELECT doc_id, mark FROM marks", "doc_id")
_SCORED = f"""WITH {_BAYES} SELECT r.doc_id, round(v.mark, 9) AS prediction, r.rating AS label
    FROM rated r JOIN ({_VOTED}) v ON v.doc_id = r.doc_id"""


@query("score_table", _SCORED)
def score_table_query(spark, folder):
    """Marks beside the truth that came with the texts."""
    scored = score_words(*words_and_scorer(tables.language_rated(spark, folder), SPECS))
    return scored.select(
        "doc_id", F.round("mark", 9).alias("prediction"), F.col("rating").alias("label")
    )


@query("score_beside_truth", _SCORED)
def score_beside_truth(spark, folder):
    """Marks joined with a truth that is another table."""
    truth = tables.language_rated(spark, folder).dropna()
    words, scorer = words_and_scorer(tables.language_rated(spark, folder), SPECS)
    scored = score_words(words.drop("rating"), scorer)
    return beside_truth(scored.withColumn("mark", F.round("mark", 9)), truth)


@query(
    "vote_accuracy",
    f"""SELECT count(*) AS n, avg((prediction = label)::DOUBLE) AS accuracy,
               round(avg(abs(label - prediction)), 9) AS mean_error,
               max(abs(label - prediction)) AS max_error FROM ({_SCORED})""",
)
def vote_accuracy(spark, folder):
    """Error figures of the voted marks."""
    report = error_report(score_table_query(spark, folder))
    return report.withColumn("mean_error", F.round("mean_error", 9))


_ONE_MORE = f"""SELECT * FROM ({S.LANGUAGE_RATED}) WHERE rating IS NOT NULL
    UNION ALL SELECT -1, NULL, '{_ONE_TEXT}'"""


@query(
    "score_one",
    f"""WITH {S.bayes(_ONE_MORE, MEMBERS, unlabelled=True)}
    SELECT '{_ONE_TEXT}' AS text, round(mark, 9) AS mark FROM ({_VOTED}) WHERE doc_id = -1""",
)
def score_one(spark, folder):
    """One text through the scorer that all documents trained."""
    arrived = one_text(spark, _ONE_TEXT)
    scored = score_table(arrived.withColumn("original", F.col("text")), _scorer(spark, folder))
    return scored.select(F.col("original").alias("text"), F.round("mark", 9).alias("mark"))


@query(
    "score_stream",
    f"WITH {_BAYES} SELECT doc_id, round(mark, 9) AS mark FROM ({_VOTED})",
)
def score_stream_query(spark, folder):
    """All documents arriving as a stream, scored into parquet."""
    scorer = _scorer(spark, folder)
    schema = tables.table(spark, folder, "documents").schema
    arriving = (
        # A pattern, so that the table may be one file or a folder of them.
        spark.readStream.schema(schema)
        .parquet(f"{folder}/documents.parque[t]")
        .where(F.col("lang").isin(list(tables.LANGUAGE_MARKS)) & F.col("text").isNotNull())
        .select("doc_id", "text")
    )
    target = work_folder(spark, "score-stream")
    cores = spark.sparkContext.defaultParallelism
    running = score_stream(
        arriving, scorer, f"{target}/marks", f"{target}/state", partitions=cores
    )
    running.awaitTermination()
    return spark.read.parquet(f"{target}/marks").select("doc_id", F.round("mark", 9).alias("mark"))
