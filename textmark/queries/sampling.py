"""Relabelling, splits, balancing, order, positions."""

from pyspark.sql import functions as F

from textmark.functions.keys import in_share
from textmark.operators import ranking, sampling
from textmark.queries import sql as S
from textmark.queries.registry import query
from textmark.settings import SHUFFLE_SEED, TRAIN_SHARE
from textmark.sources import tables


def _quality_rows(spark, folder):
    """``(doc_id, label)``: two classes of very different size."""
    return tables.table(spark, folder, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )


@query(
    "label_shift",
    f"SELECT event_id, label - 1 AS class_index, label AS mark FROM ({S.EVENT_RESULTS})",
)
def label_shift(spark, folder):
    rows = tables.event_results(spark, folder).select("event_id", "label")
    shifted = sampling.to_class_index(rows, "label", "class_index")
    return sampling.to_mark(shifted, "class_index").select("event_id", "class_index", "mark")


@query(
    "valid_marks",
    """SELECT event_id, value AS rating FROM events
       WHERE value BETWEEN 1 AND 10 AND value = floor(value)""",
)
def valid_marks(spark, folder):
    rows = tables.table(spark, folder, "events").select("event_id", F.col("value").alias("rating"))
    return sampling.valid_marks(rows)


@query(
    "target_binarize",
    f"SELECT event_id, (label = 3)::DOUBLE AS label FROM ({S.EVENT_RESULTS})",
)
def target_binarize(spark, folder):
    rows = tables.event_results(spark, folder)
    return sampling.binarise(rows, 3.0, "label").select("event_id", "label")


@query(
    "hash_split",
    f"""SELECT doc_id, substring(md5('s' || doc_id::VARCHAR), 1, 8) < '{S.TRAIN_LIMIT}' AS in_train
        FROM documents""",
)
def hash_split(spark, folder):
    keys = tables.table(spark, folder, "documents").select("doc_id")
    return keys.withColumn("in_train", in_share(F.col("doc_id"), TRAIN_SHARE, "s"))


@query("random_split")
def random_split(spark, folder):
    """``(doc_id, part)`` of Spark's seeded row-wise split."""
    keys = tables.table(spark, folder, "documents").select("doc_id")
    train, test = sampling.random_split(keys, SHUFFLE_SEED)
    return sampling.union_labelled(
        train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))
    )


@query(
    "random_split_sizes",
    "SELECT count(*) AS n, count(DISTINCT doc_id) AS n_keys, TRUE AS near_share FROM documents",
)
def random_split_sizes(spark, folder):
    """Both sides together hold every row once; the share is about the wanted one."""
    parts = random_split(spark, folder)
    off = F.abs(F.avg((F.col("part") == "train").cast("double")) - TRAIN_SHARE)
    return parts.agg(
        F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_keys"),
        (off * F.sqrt(F.count("*")) < 3).alias("near_share"),
    )


@query(
    "stratified_split",
    f"""SELECT doc_id, label, place <= {TRAIN_SHARE}::DOUBLE * n AS in_train FROM (
        SELECT doc_id, quality::DOUBLE AS label, count(*) OVER (PARTITION BY quality) AS n,
               row_number() OVER (PARTITION BY quality
                   ORDER BY md5('{SHUFFLE_SEED}' || doc_id::VARCHAR), doc_id) AS place
        FROM labels)""",
)
def stratified_split(spark, folder):
    return sampling.stratified_split(
        _quality_rows(spark, folder), "doc_id", salt=str(SHUFFLE_SEED)
    )


@query(
    "balanced_undersample",
    """SELECT doc_id, label FROM (
        SELECT doc_id, label, place, min(n) OVER () AS n_min FROM (
            SELECT doc_id, quality::DOUBLE AS label, count(*) OVER (PARTITION BY quality) AS n,
                   row_number() OVER (PARTITION BY quality
                       ORDER BY md5(doc_id::VARCHAR), doc_id) AS place
            FROM labels)) WHERE place <= n_min""",
)
def balanced_undersample(spark, folder):
    return sampling.balance(_quality_rows(spark, folder), "doc_id")


@query(
    "balanced_events",
    """SELECT event_id, label FROM (
        SELECT event_id, label, place, min(n) OVER () AS n_min FROM (
            SELECT event_id, (event_type = 'purchase')::DOUBLE AS label,
                   count(*) OVER (PARTITION BY event_type = 'purchase') AS n,
                   row_number() OVER (PARTITION BY event_type = 'purchase'
                       ORDER BY md5('b' || event_id::VARCHAR), event_id) AS place
            FROM events)) WHERE place <= n_min""",
)
def balanced_events(spark, folder):
    """Balancing a larger table: four of five rows are in one class."""
    rows = tables.table(spark, folder, "events").select(
        "event_id", (F.col("event_type") == "purchase").cast("double").alias("label")
    )
    return sampling.balance(rows, "event_id", salt="b")


@query(
    "seeded_shuffle",
    f"""SELECT event_id, row_number() OVER (
            ORDER BY md5('{SHUFFLE_SEED}' || event_id::VARCHAR), event_id) AS position
        FROM events""",
)
def seeded_shuffle(spark, folder):
    keys = tables.table(spark, folder, "events").select("event_id")
    return sampling.shuffle_positions(keys, "event_id")


@query(
    "row_numbers",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx FROM events",
)
def row_numbers(spark, folder):
    rows = tables.table(spark, folder, "events").select("event_id", "ts")
    return ranking.row_index(rows, ["ts", "event_id"]).select("event_id", "idx")


@query(
    "positional_pair",
    """SELECT l.idx, l.doc_id, l.lang, r.label_doc, r.quality
       FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents) l
       JOIN (SELECT doc_id AS label_doc, quality,
                    row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM labels) r
         ON l.idx = r.idx""",
)
def positional_pair(spark, folder):
    left = tables.table(spark, folder, "documents").select("doc_id", "lang")
    right = tables.table(spark, folder, "labels").select(
        F.col("doc_id").alias("label_doc"), "quality"
    )
    return sampling.pair_by_position(left, right, ["doc_id"], ["label_doc"])


@query(
    "union_labelled",
    """SELECT doc_id, 1.0::DOUBLE AS label FROM labels WHERE quality = 1
       UNION ALL SELECT doc_id, 0.0::DOUBLE AS label FROM labels WHERE quality <> 1""",
)
def union_labelled(spark, folder):
    labels = tables.table(spark, folder, "labels")
    positive = labels.where(F.col("quality") == 1).select("doc_id", F.lit(1.0).alias("label"))
    negative = labels.where(F.col("quality") != 1).select(F.lit(0.0).alias("label"), "doc_id")
    return sampling.union_labelled(positive, negative)


@query(
    "limit_in_order",
    "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 500",
)
def limit_in_order(spark, folder):
    rows = tables.table(spark, folder, "events").select("event_id", "value")
    return ranking.limit_in_order(rows, [F.desc("value"), F.asc("event_id")], 500)


@query(
    "class_counts",
    "SELECT quality::DOUBLE AS label, count(*) AS n FROM labels GROUP BY quality",
)
def class_counts(spark, folder):
    return sampling.class_counts(_quality_rows(spark, folder))


@query(
    "smallest_class",
    "SELECT min(n) AS n FROM (SELECT count(*) AS n FROM labels GROUP BY quality)",
)
def smallest_class(spark, folder):
    return sampling.smallest_class(_quality_rows(spark, folder))


@query(
    "drop_failed",
    f"""SELECT event_id, mark FROM (
        SELECT event_id, CASE WHEN member = 'error' THEN -1 ELSE prediction END::DOUBLE AS mark
        FROM ({S.EVENT_RESULTS})) WHERE mark <> -1""",
)
def drop_failed(spark, folder):
    rows = tables.event_results(spark, folder)
    mark = F.when(F.col("member") == "error", F.lit(-1.0)).otherwise(F.col("prediction"))
    return sampling.drop_failed(rows.select("event_id", mark.alias("mark")))
