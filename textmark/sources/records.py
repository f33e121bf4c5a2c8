"""Quoted CSV records that span lines, cut by many tasks.

A reader of whole files needs one task a file, as a line break may stand inside quotes.
Here every split of a file is read by its own task, twice:

1. Each split says in which state it ends, inside quotes or not, for both states it may
   begin in.  These pairs are composed in file order, one row a split, so that each
   split's own beginning is known.
2. Each split cuts its lines into records.  What a split cannot end or begin itself, at
   most two fragments, is put together with its neighbours' fragments.

A record must fit in a task, as with any reader.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmark.runtime import written

# A quoted field up to its end or the end of the line; quotes inside are doubled.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_CLOSING = re.compile(rf'{_INSIDE}"(?!")[^,]*+')
_FIELD = re.compile(rf'(?:"{_INSIDE}"(?!")[^,]*+|(?!")[^,]*+)')

RECORD, HEAD, MIDDLE, TAIL, HEADER = range(5)
_BLOCK = "file long, start long"


def stays_open(line: str, opened: bool) -> bool:
    """Whether a quoted field is open after ``line``, if one was ``opened`` before it.

    A quote inside a field that does not begin with one is a plain sign.
    """
    if '"' not in line:
        return opened
    at = 0
    if opened:
        closing = _CLOSING.match(line)
        if closing is None:
            return True
        at = closing.end()
        if at == len(line):
            return False
        at += 1
    while True:
        field = _FIELD.match(line, at)
        if field is None:
            return True
        at = field.end() + 1
        if at > len(line):
            return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, line)`` in file order within each split."""
    split = F.col("_metadata")
    return spark.read.text(path, lineSep="\n").select(
        F.xxhash64(split["file_path"]).alias("file"), split["file_block_start"].alias("start"), F.col("value").alias("line")
    )


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows grouped by ``(file, start)``; a task reads its splits one after the other."""
    rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns), strict=True))
    return groupby(rows, key=lambda row: row[:2])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = []
    for split, rows in _by_split(batches):
        states = [False, True]
        for row in rows:
            states = [stays_open(row[2], state) for state in states]
        found.append((*split, *map(int, states)))
    if found:
        columns = [pa.array(column, pa.int64()) for column in zip(*found, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["file", "start", "if_closed", "if_open"])


def beginnings(ends: DataFrame) -> DataFrame:
    """``(file, start, opened)``: the states of all splits before each one, composed.

    A split that ends alike from both states fixes the state; those after it keep or turn
    it.  So the state before a split is the last fixed one, turned as often as splits
    have turned it since.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    turned = F.sum((F.col("if_closed") > F.col("if_open")).cast("long"))
    fixed = F.col("if_closed") == F.col("if_open")
    counted = ends.withColumn("_turns", turned.over(upto)).withColumn("_fixed", fixed)

    def last(value: str) -> F.Column:
        return F.coalesce(F.last(F.when(F.col("_fixed"), F.col(value)), ignorenulls=True).over(before), F.lit(0))

    turns = F.coalesce(F.last("_turns").over(before), F.lit(0)) - last("_turns")
    return counted.select("file", "start", ((last("if_closed") + turns) % 2 == 1).alias("opened"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, start), rows in _by_split(batches):
        kind, opened, kept, done, size = None, False, [], [], 0

        def batch(done: list[tuple[int, str]], file: int = file, start: int = start) -> pa.RecordBatch:
            kinds, texts = zip(*done, strict=True)
            where = [pa.array([value] * len(done), pa.int64()) for value in (file, start)]
            columns = [*where, pa.array(kinds, pa.int32()), pa.array(texts, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["file", "start", "kind", "record"])

        for _, _, line, begins in rows:
            if kind is None:
                opened = begins
                kind = HEAD if begins else HEADER if start == 0 else RECORD
            opened = stays_open(line, opened)
            kept.append(line)
            if not opened:
                record = "\n".join(kept)
                done.append((kind, record))
                size += len(record)
                kind, kept = RECORD, []
            if size > 1 << 22:
                yield batch(done)
                done, size = [], 0
        if kept:
            done.append((MIDDLE if kind == HEAD else TAIL, "\n".join(kept)))
        if done:
            yield batch(done)


def joined_fragments(fragments: DataFrame) -> DataFrame:
    """``(file, record)``: a tail, the splits in its midst and the head that ends it.

    A tail that nothing ends is a record too: its quotes were never closed.
    """
    in_order = Window.partitionBy("file").orderBy("start", "kind")
    number = F.sum((F.col("kind") == TAIL).cast("long")).over(in_order)
    parts = F.array_sort(F.collect_list(F.struct("start", "record")))
    grouped = fragments.withColumn("_number", number).groupBy("file", "_number").agg(parts.alias("_parts"))
    return grouped.select("file", F.array_join(F.transform("_parts", lambda part: part["record"]), "\n").alias("record"))


def read_records(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, list[str]]:
    """``(file, record)`` without headers, and the distinct headers (two at most).

    Without ``header`` the first record of a file is one like the others.

    Splits are named by file and first byte.  Should a second reading of the files split
    them otherwise, it ends with an error; it never cuts in the wrong place.  The states
    are broadcast: one row a split, less than the scan's own plan holds for it.
    """
    lines = _lines(spark, path)
    ends = written(lines.mapInArrow(_ends, f"{_BLOCK}, if_closed long, if_open long"), "csv-splits")
    known = lines.join(F.broadcast(beginnings(ends)), ["file", "start"], "left")
    changed = F.raise_error(F.lit("the files were split otherwise at the second reading"))
    known = known.select("file", "start", "line", F.coalesce("opened", changed.cast("boolean")).alias("opened"))
    cut = written(known.mapInArrow(_cut, f"{_BLOCK}, kind int, record string"), "csv-records")
    whole = cut.where(F.col("kind").isin(RECORD) if header else F.col("kind").isin(RECORD, HEADER)).select("file", "record")
    parts = cut.where(F.col("kind").isin(HEAD, MIDDLE, TAIL))
    records = whole.unionByName(joined_fragments(parts))
    records = records.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where("record <> ''")
    if not header:
        return records, []
    headers = cut.where(F.col("kind") == HEADER).select("record").distinct().limit(2).collect()
    return records, [row["record"].removesuffix("\r") for row in headers]


def read_fields(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> DataFrame:
    """The columns that the header names, as strings, then ``_record`` and ``_broken``.

    With ``names`` the files have no header.

    ``_record`` is the record's own text.  ``_broken`` tells that it has more or fewer
    fields than the header; fields that it lacks are NULL.  A column without a name is
    called ``_c`` and its number.  Files with different headers are an error.
    """
    records, headers = read_records(spark, path, header=names is None)
    if len(headers) > 1:
        raise ValueError(f"{path}: different headers, such as {headers}")
    if names is None:
        names = next(csv.reader([headers[0]])) if headers else []
    names = [name or f"_c{i}" for i, name in enumerate(names)]
    if len(set(names)) < len(names) or not {"_record", "_broken"}.isdisjoint(names):
        raise ValueError(f"{path}: columns need names of their own: {names}")
    quoted = ["`" + name.replace("`", "``") + "` string" for name in [*names, "_broken"]]
    options = {
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_broken",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    parsed = records.select(F.from_csv("record", ", ".join(quoted), options).alias("_fields"), "record")
    fields = [F.col("_fields")[name].alias(name) for name in names]
    broken = F.col("_fields")["_broken"].isNotNull()
    return parsed.select(*fields, F.col("record").alias("_record"), broken.alias("_broken"))
