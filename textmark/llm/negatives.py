"""Hard negatives of anchors by the threshold algorithm over per-dimension sorted lists.

Rows are integer vectors with a label; a row's score for an anchor is their inner product,
higher first, ties by smaller id.  Positives of an anchor are its best rows of the same
label; for each of them, hard negatives are the best rows of other labels whose score lies
in a window below the positive's.

1. Rows are dealt into shards of about ``SHARD`` rows; each holds one list per dimension,
   sorted by value.  Anchors stream through the shards, a batch at a time.
2. *Sorted access*: the lists are read in the direction of the sign of the anchor's
   component, all to the same depth, which doubles from round to round; once half of the
   shard's rows were met, reading on saves nothing and the others are met at once.
3. *Random access*: rows that were met for the first time are scored exactly, in integers.
4. *Stop*: no row below that depth scores more than the threshold, the sum of the anchor's
   components times the values that stand there.  An anchor is done once the threshold is
   strictly below the k-th score of each of its windows, or below the window itself: an
   equal score with a smaller id may still come before that.
5. The best of all shards are merged by a window that keeps k rows of each shard at most.

Positives visit the shards of their own label alone, a label of many rows having many
shards; negatives visit all shards.  Anchors are copied once per shard, rows never.

Defined results: rows with a null label, a null vector, or null or non-finite components
take no part; vectors meet those of their own length only; a null id is no anchor and comes
after all others in ties; rows that repeat an id are rows of their own (an anchor is not its
own positive, a copy of it is); anchors without positives and positives without negatives
have no rows; other columns are not read.  Components from ``LARGEST`` on, and scores that
do not fit 64 bits, raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmark.llm.frames import narrowed, stored

SHARD = 8192
DEPTH = 32
#: Anchors that are scored at once in a shard.
TOGETHER = 64
LARGEST = 1 << 62
_NULL_LAST = np.iinfo(np.int64).max


def scaled(df: DataFrame, vec_id: str, embedding: str, label: Column, scale: int, anchor: Column) -> DataFrame:
    """``(row, id, label, anchor, width, vector)`` of the rows that take part, written.

    ``row`` tells rows apart that repeat an id.
    """
    x = F.transform(F.col(embedding), lambda v: F.floor(v.cast("double") * F.lit(float(scale))))
    sound = F.forall(
        embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf")))
    )
    rows = df.where(F.col(embedding).isNotNull()).where(sound).select(
        F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.size(embedding).alias("width"), x.alias("vector"),
    )
    rows = rows.where("label is not null")
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "*"), "negatives-rows")


class Lists:
    """Rows of a shard with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((rows, ids))  # ties of a score then stand in the order of ids
        self.ids, self.rows, self.labels, self.vectors = ids[order], rows[order], labels[order], vectors[order]
        across = np.ascontiguousarray(self.vectors.T)
        self.lists = np.argsort(across, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(across, self.lists, axis=1)
        self.bound = int(np.abs(self.vectors).max(initial=0))
        self.floats = self.vectors.astype(np.float64) if self.bound < 1 << 53 else None

    def _scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        most = self.bound * int(np.abs(anchor).max(initial=0)) * max(1, len(anchor))
        if most < 1 << 53 and self.floats is not None:
            anchor = anchor.astype(np.float64)
            if 4 * len(rows) > len(self.ids):  # cheaper than a copy of so many rows
                return (self.floats @ anchor)[rows].astype(np.int64)
            return (self.floats[rows] @ anchor).astype(np.int64)
        vectors = self.vectors[rows]
        if most < 1 << 63:
            return vectors @ anchor
        return (vectors.astype(object) @ anchor.astype(object)).astype(np.int64)

    def best(self, anchor: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        """Places and scores of the first k allowed rows in each window ``low <= score <= high``.

        Also returns how many rows were scored.
        """
        n = len(self.ids)
        used = np.flatnonzero(anchor)
        down = anchor[used] > 0
        falling, rising = used[down], used[~down]
        scores = np.zeros(n, np.int64)
        met = np.zeros(n, bool)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(low)
        waiting = np.arange(len(low))
        depth, read = DEPTH, 0
        if len(used) == 0:  # every score is 0 and nothing orders the lists
            depth = n
            met[:] = True
            fresh = np.arange(n)
        while True:
            depth = min(depth, n)
            if len(used):
                if depth == n:
                    fresh = np.flatnonzero(~met)
                else:
                    reached = np.zeros(n, bool)
                    reached[self.lists[falling, n - depth : n - read]] = True
                    reached[self.lists[rising, read:depth]] = True
                    fresh = np.flatnonzero(reached & ~met)
                met[fresh] = True
            if len(fresh):
                scores[fresh] = self._scores(fresh, anchor)
            fresh = fresh[allowed[fresh]]
            if depth < n:
                edge = self.sorted[used, np.where(down, n - depth, depth - 1)]
                threshold = int((edge.astype(object) * anchor[used].astype(object)).sum())
            else:
                threshold = None
            still = []
            for w in waiting.tolist():
                inside = fresh[(scores[fresh] >= low[w]) & (scores[fresh] <= high[w])]
                if len(inside) > k:  # all that may be among the first k, ties too
                    own = scores[inside]
                    inside = inside[own >= np.partition(own, len(own) - k)[len(own) - k]]
                if len(inside):
                    place = np.append(found[w][0], inside)
                    place = place[np.lexsort((place, -scores[place]))][:k]
                    found[w] = (place, scores[place])
                least = found[w][1][-1] if len(found[w][0]) == k else low[w]
                if threshold is not None and threshold >= least:
                    still.append(w)
            waiting = np.array(still, np.int64)
            if len(waiting) == 0 or depth == n:
                return found, int(met.sum())
            read, depth = depth, n if 2 * int(met.sum()) >= n else 2 * depth


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(column), width)


def _shards(work, fields: pa.Schema):
    """Stream rows sorted by ``(width, group, shard, kind, ...)``: rows of a shard, then its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        lists, of = None, None
        for batch in batches:
            names = ["width", "group", "shard"]
            keys = [batch.column(x).to_numpy() for x in names]
            kind = batch.column("kind").to_numpy()
            edge = np.ones(batch.num_rows, bool)
            for x in (*keys, kind):
                edge[1:] &= x[1:] == x[:-1]
            cuts = np.append(np.flatnonzero(~edge | (np.arange(len(kind)) == 0)), len(kind))
            for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                key = tuple(int(x[start]) for x in keys)
                part = batch.slice(start, stop - start)
                if key != of:
                    held, lists, of = [], None, key
                if kind[start] == 0:
                    held.append(part)
                    continue
                if lists is None and held:
                    table = pa.Table.from_batches(held).combine_chunks()
                    lists = Lists(
                        table.column("id").combine_chunks().fill_null(_NULL_LAST).to_numpy(zero_copy_only=False),
                        table.column("row").to_numpy(), table.column("label").to_numpy(),
                        _vectors(table.column("vector").combine_chunks(), key[0]),
                    )
                    held = []
                if lists is None:
                    continue  # no row in this shard
                for at in range(0, part.num_rows, TOGETHER):
                    rows = work(lists, part.slice(at, TOGETHER), key[0])
                    if rows:
                        columns = [pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), fields, strict=True)]
                        yield pa.RecordBatch.from_arrays(columns, schema=fields)

    return run


def _id(value: int) -> int | None:
    return None if value == _NULL_LAST else value


_POSITIVES = pa.schema(
    [("anchor", pa.int64()), ("positive_id", pa.int64()), ("positive_row", pa.int64()), ("positive_score", pa.int64())]
)
_NEGATIVES = pa.schema([("anchor", pa.int64()), ("window", pa.int64()), ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def _positives(k: int):
    def work(lists: Lists, anchors: pa.RecordBatch, width: int) -> list[tuple]:
        out = []
        vectors = _vectors(anchors.column("vector"), width)
        low, high = np.array([np.iinfo(np.int64).min]), np.array([np.iinfo(np.int64).max])
        for row, label, vector in zip(anchors.column("row").to_pylist(), anchors.column("label").to_pylist(), vectors, strict=True):
            allowed = (lists.labels == label) & (lists.rows != row)
            (place, score), = lists.best(vector, allowed, low, high, k)[0]
            out += [(row, _id(i), r, s) for i, r, s in zip(lists.ids[place].tolist(), lists.rows[place].tolist(), score.tolist(), strict=True)]
        return out

    return work


def _negatives(k: int):
    def work(lists: Lists, anchors: pa.RecordBatch, width: int) -> list[tuple]:
        out = []
        vectors = _vectors(anchors.column("vector"), width)
        for row, label, vector, windows in zip(
            anchors.column("row").to_pylist(), anchors.column("label").to_pylist(), vectors, anchors.column("windows").to_pylist(), strict=True
        ):
            allowed = lists.labels != label
            low, high = np.array([x["low"] for x in windows]), np.array([x["high"] for x in windows])
            for x, (place, score) in zip(windows, lists.best(vector, allowed, low, high, k)[0], strict=True):
                out += [(row, x["window"], _id(i), s) for i, s in zip(lists.ids[place].tolist(), score.tolist(), strict=True)]
        return out

    return work


def _visited(rows: DataFrame, anchors: DataFrame, group: Column, shard: int, work, fields: pa.Schema, schema: str) -> DataFrame:
    """Every anchor's batch in every shard of its group."""
    placed = rows.withColumn("group", group)
    counts = placed.groupBy("width", "group").agg(F.ceil(F.count("*") / shard).cast("long").alias("shards"))
    counts = stored(counts, "negatives-shards")
    own = F.pmod(F.xxhash64("row"), F.col("shards"))
    columns = ["width", "group", "shard", "kind", "row", "id", "label", "vector", "windows"]
    windows = F.lit(None).cast(dict(anchors.dtypes)["windows"]).alias("windows")
    one = narrowed(placed, counts, ["width", "group"]).select(
        "width", "group", own.alias("shard"), F.lit(0).alias("kind"), "row", "id", "label", "vector", windows
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))
    other = narrowed(anchors.withColumn("group", group), counts, ["width", "group"]).select(
        "width", "group", every.alias("shard"), F.lit(1).alias("kind"), "row", "id", "label", "vector", "windows"
    )
    both = one.union(other).select(*columns)
    both = both.repartition("width", "group", "shard").sortWithinPartitions("width", "group", "shard", "kind", "row")
    return both.mapInArrow(_shards(work, fields), schema)


def _first(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def mined(
    df: DataFrame, label: Column, anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256,
    positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, shard: int = SHARD,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Negatives lie in ``least * p <= 100 * score <= most * p`` for the positive's score p.
    """
    if not 0 <= least < most:
        raise ValueError("the window must lie below the positive's score: 0 <= least < most")
    rows = scaled(df, vec_id, embedding, label, scale, anchor)
    far = F.exists("vector", lambda v: F.abs(v) >= F.lit(LARGEST))
    error = F.raise_error(F.lit("a component is too large for integer scores"))
    rows = rows.withColumn("vector", F.when(far, error.cast("array<bigint>")).otherwise(F.col("vector")))
    anchors = rows.where("anchor and id is not null")
    none = F.expr("cast(null as array<struct<window:bigint,low:bigint,high:bigint>>)")
    found = _visited(
        rows, anchors.withColumn("windows", none), F.col("label"), shard, _positives(positives), _POSITIVES,
        "anchor long, positive_id long, positive_row long, positive_score long",
    )
    order = [F.desc("positive_score"), F.asc_nulls_last("positive_id"), F.asc("positive_row")]
    found = stored(_first(found, ["anchor"], order, positives).withColumnRenamed("rank", "window"), "negatives-positives")
    p = F.col("positive_score")
    # Whole scores between p * least / 100 and p * most / 100; a negative p leaves none.
    low = F.expr(f"(positive_score * {least} + 99) div 100").alias("low")
    high = F.expr(f"positive_score * {most} div 100").alias("high")
    bounds = found.where("positive_score >= 0").select(
        "anchor", F.struct(F.col("window").cast("long").alias("window"), low, high).alias("w")
    )
    bounds = bounds.where("w.low <= w.high")
    bounds = bounds.groupBy("anchor").agg(F.array_sort(F.collect_list("w")).alias("windows"))
    searching = anchors.join(bounds.withColumnRenamed("anchor", "row"), "row")
    hard = _visited(
        rows, searching, F.lit(0).cast("long"), shard, _negatives(negatives), _NEGATIVES,
        "anchor long, window long, negative_id long, negative_score long",
    )
    order = [F.desc("negative_score"), F.asc_nulls_last("negative_id")]
    hard = _first(hard, ["anchor", "window"], order, negatives)
    names = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    out = hard.join(found.select("anchor", F.col("window").cast("long").alias("window"), "positive_id", p), ["anchor", "window"])
    return out.join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
