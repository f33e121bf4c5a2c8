"""Members that really fail on some of the documents."""

import re

from pyspark.sql import functions as F

from textmark.plans import guarded
from textmark.queries import sql as S
from textmark.queries.registry import query
from textmark.sources import tables

_NUMBER = re.compile("[0-9]{1,6}")


# A missing text, a text without a number and one without blanks make these raise.
def _by_number(texts):
    return texts.map(lambda text: 1 + int(_NUMBER.search(text).group()) % 10)


def _by_words(texts):
    return texts.map(lambda text: 1 + len(text) // text.count(" ") % 10)


def _by_commas(texts):
    return texts.map(lambda text: 1 + text.count(",") % 10)


RATERS = [
    guarded.Rater("number", _by_number),
    guarded.Rater("words", _by_words),
    guarded.Rater("commas", _by_commas),
]
_NAMES = [rater.name for rater in RATERS]


def _count(sign):
    return f"(length(text) - length(replace(text, '{sign}', '')))"


_NUMBER_SQL = "nullif(regexp_extract(text, '[0-9]{1,6}'), '')::BIGINT"
_MARKS = f"""given AS (
    SELECT doc_id, 'number' AS member, (1 + {_NUMBER_SQL} % 10)::DOUBLE AS mark,
           CASE WHEN text IS NULL THEN 'TypeError' ELSE 'AttributeError' END AS error FROM documents
    UNION ALL
    SELECT doc_id, 'words', (1 + (length(text) // nullif({_count(' ')}, 0)) % 10)::DOUBLE,
           CASE WHEN text IS NULL THEN 'TypeError' ELSE 'ZeroDivisionError' END FROM documents
    UNION ALL
    SELECT doc_id, 'commas', (1 + {_count(',')} % 10)::DOUBLE, 'AttributeError' FROM documents)"""


def _marked(spark, folder):
    return guarded.with_raters(tables.table(spark, folder, "documents").select("doc_id", "text"), RATERS)


@query(
    "vote_of_failing_members",
    f"""WITH {_MARKS} SELECT doc_id, round(v.mark, 9) AS mark, failed FROM ({S.vote('FROM given', 'doc_id')}) v
    JOIN (SELECT doc_id, (count(*) - count(mark))::INTEGER AS failed FROM given GROUP BY doc_id) USING (doc_id)""",
)
def vote_of_failing_members(spark, folder):
    """The members that can mark a document do; the others' failures are counted."""
    voted = guarded.vote_of(_marked(spark, folder), _NAMES)
    return voted.select("doc_id", F.round("mark", 9).alias("mark"), "failed")


@query("quarantined_marks", f"WITH {_MARKS} SELECT doc_id, member, error FROM given WHERE mark IS NULL")
def quarantined_marks(spark, folder):
    """Which member failed on which document, and by what kind of error."""
    kind = F.substring_index("error", ":", 1).alias("error")
    return guarded.quarantine(_marked(spark, folder), ["doc_id"], _NAMES).select("doc_id", "member", kind)
