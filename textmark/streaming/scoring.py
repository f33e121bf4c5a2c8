"""Score texts as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from textmark.plans.scoring import Scorer, score_table


def score_stream(
    arriving: DataFrame,
    scorer: Scorer,
    out: str,
    checkpoint: str,
    key: str = "doc_id",
    text: str = "text",
    available_now: bool = True,
    partitions: int | None = None,
) -> StreamingQuery:
    """Append a mark for every arriving text to parquet below ``out``.

    Stateless, so there is nothing to grow.  Each batch has a folder of its own,
    ``batch=<number>``, whatever the scorer holds; a restart from ``checkpoint``
    overwrites the folder of the batch it repeats, so no row comes twice.  ``partitions`` spreads the texts of a source
    that has fewer files than the cluster has cores.
    """
    if partitions:
        arriving = arriving.repartition(partitions)

    def write(batch: DataFrame, number: int) -> None:
        scored = score_table(batch, scorer, key, text)
        scored.write.mode("overwrite").parquet(f"{out}/batch={number}")

    # One form for all scorers: word tables need joins, some models cache their input,
    # and neither works on a stream itself.
    writer = arriving.writeStream.foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
