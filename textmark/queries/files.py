"""Files written by Spark from the tables and read back."""

from pyspark.sql import functions as F

from textmark.queries import sql as S
from textmark.queries.registry import query
from textmark.runtime import work_folder
from textmark.sources import reviews, samples, tables, words


@query("csv_reviews_roundtrip", f"SELECT doc_id, rating, text FROM ({S.LANGUAGE_RATED})")
def csv_reviews_roundtrip(spark, folder):
    """Texts with quotes and line breaks survive the review file."""
    path = work_folder(spark, "reviews")
    reviews.write_csv(tables.language_rated(spark, folder), path)
    read = reviews.read_reviews(spark, path)
    return read.select(F.col("doc_id").cast("long").alias("doc_id"), "rating", "text")


@query(
    "csv_rejects",
    f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE bad_rating) AS no_rating,
               count(*) FILTER (WHERE bad_text) AS no_text,
               count(*) FILTER (WHERE bad_rating OR bad_text) AS n_rejected
        FROM (SELECT doc_id % 5 = 0 OR rating IS NULL AS bad_rating, doc_id % 7 = 0 AS bad_text
              FROM ({S.LANGUAGE_RATED}))""",
)
def csv_rejects(spark, folder):
    """Unreadable ratings and missing texts, counted after a file round trip."""
    path = work_folder(spark, "rejects")
    rated = tables.language_rated(spark, folder)
    bad = rated.select(
        "doc_id",
        F.when(F.col("doc_id") % 5 == 0, F.lit("n/a"))
        .otherwise(F.col("rating").cast("string"))
        .alias("rating"),
        F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("text"),
    )
    reviews.write_csv(bad, path)
    return reviews.rejected(reviews.read_reviews(spark, path))


@query(
    "csv_rejected_records",
    """SELECT doc_id || ',' || CASE WHEN doc_id % 5 = 0 THEN 'n/a' ELSE '3.5' END
               || ',"' || replace(text, '"', '""') || '"' || CASE WHEN doc_id % 7 = 0 THEN ',more' ELSE '' END
               AS record, doc_id % 7 = 0 AS wrong_fields, doc_id % 5 = 0 AS no_rating, FALSE AS no_text
        FROM documents WHERE text <> '' AND (doc_id % 5 = 0 OR doc_id % 7 = 0)""",
)
def csv_rejected_records(spark, folder):
    """Records with a field too many or a rating that is none, with their whole text."""
    path = work_folder(spark, "rejected")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    rating = F.when(F.col("doc_id") % 5 == 0, F.lit("n/a")).otherwise(F.lit("3.5"))
    record = F.concat_ws(",", F.col("doc_id").cast("string"), rating, quoted)
    record = F.concat(record, F.when(F.col("doc_id") % 7 == 0, F.lit(",more")).otherwise(F.lit("")))
    texts = tables.table(spark, folder, "documents").where("text <> ''").select(record.alias("value"))
    texts.write.text(path)
    return reviews.rejects(spark, path, ["doc_id", "rating", "text"])


@query("csv_results_roundtrip", f"SELECT event_id, prediction, label FROM ({S.EVENT_RESULTS})")
def csv_results_roundtrip(spark, folder):
    path = work_folder(spark, "results")
    results = tables.event_results(spark, folder).select("event_id", "prediction", "label")
    reviews.write_csv(results, path)
    read = reviews.read_results(spark, path)
    return read.select(F.col("event_id").cast("long").alias("event_id"), "prediction", "label")


@query("word_list", "SELECT DISTINCT event_type AS word FROM events")
def word_list(spark, folder):
    """A list with repeated lines, read as a set."""
    path = work_folder(spark, "words")
    lines = tables.table(spark, folder, "events").select("event_type")
    lines.write.mode("overwrite").text(path)
    return words.read_word_list(spark, path)


@query("sample_files", "SELECT item_id::INTEGER AS mark, text FROM benchmark")
def sample_files(spark, folder):
    """One file per text; the number in its path is its mark."""
    path = work_folder(spark, "samples")
    items = tables.table(spark, folder, "benchmark").select("item_id", "text")
    items.write.mode("overwrite").partitionBy("item_id").option("lineSep", "\u0003").text(path)
    read = samples.read_sample_files(spark, path, r"item_id=(\d+)/")
    return read.select("mark", F.rtrim("text", F.lit("\u0003")).alias("text"))
