"""Error figures over scored rows."""

from pyspark.sql import functions as F

from textmark.operators import metrics
from textmark.operators.sampling import binarise
from textmark.queries import sql as S
from textmark.queries.registry import query
from textmark.sources import tables

_FIGURES = """count(*) AS n, avg((prediction = label)::DOUBLE) AS accuracy,
    round(avg(abs(label - prediction)), 9) AS mean_error, max(abs(label - prediction)) AS max_error"""


def _rounded(report):
    return report.withColumn("mean_error", F.round("mean_error", 9))


@query("error_stats", f"SELECT {_FIGURES} FROM ({S.EVENT_RESULTS})")
def error_stats(spark, folder):
    return _rounded(metrics.error_report(tables.event_results(spark, folder)))


_MISSING = f"""SELECT * REPLACE (CASE WHEN member = 'view' THEN NULL ELSE prediction END AS prediction)
    FROM ({S.EVENT_RESULTS})"""


@query(
    "accuracy_with_missing",
    f"""SELECT member, count(*) AS n, sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) / count(label) AS accuracy
        FROM ({_MISSING}) GROUP BY member""",
)
def accuracy_with_missing(spark, folder):
    """Rows without a prediction count as misses."""
    given = F.when(F.col("member") != "view", F.col("prediction"))
    rows = tables.event_results(spark, folder).withColumn("prediction", given)
    return metrics.error_report(rows, ["member"]).select("member", "n", "accuracy")


@query("accuracy_report", f"SELECT member, {_FIGURES} FROM ({S.EVENT_RESULTS}) GROUP BY member")
def accuracy_report(spark, folder):
    return _rounded(metrics.error_report(tables.event_results(spark, folder), ["member"]))


@query(
    "auc_hard",
    f"""SELECT round((avg(CASE WHEN label = 5 THEN (prediction = 5)::DOUBLE END)
                    + avg(CASE WHEN label <> 5 THEN (prediction <> 5)::DOUBLE END)) / 2, 9) AS auc
        FROM ({S.EVENT_RESULTS})""",
)
def auc_hard(spark, folder):
    rows = tables.event_results(spark, folder)
    classes = binarise(binarise(rows, 5.0, "label"), 5.0, "prediction", "prediction")
    return classes.agg(F.round(metrics.auc_of_classes(), 9).alias("auc"))


@query(
    "confusion",
    f"SELECT label, prediction, count(*) AS n FROM ({S.EVENT_RESULTS}) GROUP BY label, prediction",
)
def confusion(spark, folder):
    return metrics.confusion(tables.event_results(spark, folder))


@query(
    "stage_counts",
    f"""SELECT 'read' AS stage, count(*) AS n FROM ({S.QUALITY_RATED})
        UNION ALL SELECT 'positive', count(*) FROM ({S.QUALITY_RATED}) WHERE rating = 1
        UNION ALL SELECT 'negative', count(*) FROM ({S.QUALITY_RATED}) WHERE rating <> 1""",
)
def stage_counts_query(spark, folder):
    rows = tables.quality_rated(spark, folder).select("doc_id", "rating")
    positive = F.col("rating") == 1.0
    return metrics.stage_counts(
        rows, {"read": F.lit(True), "positive": positive, "negative": ~positive}
    )
