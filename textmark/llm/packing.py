"""Documents packed into sequences of bounded length: dominance reduction, then best fit.

Texts become token ids in one pass; longer ones are cut.  How pieces share sequences
depends on their lengths alone, so the instance is a table of counts per length, at most
``capacity`` rows however many documents there are.  It is solved on the driver in whole
groups of equal sequences:

1. Reduction after Martello and Toth: for the longest open length, a set that dominates
   every other set with that length is fixed for good: the piece alone, the largest
   partner where no third piece fits or the sequence is full, or a dominating pair.
   Fixed pieces leave the instance; the rest is reduced again until nothing more is fixed.
2. What remains goes best fit, longest first.

The plan maps ranks of a length to sequences.  Pieces get their rank from counts per split
and length, so no length, however common, meets in one task.

Defined results: a null or empty text is the end token alone; a null key is carried along;
equal rows are packed each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmark.llm.frames import stored

CAPACITY = 2048
END = 0
ROWS = 500

#: Text for which both libraries' character tables agree without question.
_PLAIN = re.compile("[\t\n\r -~¡-ž]*")
_encoders: dict[tuple[str, str | None], Encoder] = {}


class Encoder:
    """Token ids of texts by a byte-level BPE file.

    ``ranks`` names the same vocabulary in the format of the other library, which is several
    times faster; it takes texts of plain characters without the end-of-text sign, on which
    both give the same ids.  All other texts are encoded by the file itself.
    """

    def __init__(self, path: str, ranks: str | None, pattern: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.fast = None
        if ranks is not None:
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and _PLAIN.fullmatch(text) and "<|endoftext|>" not in text:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")


def encoder(path: str, ranks: str | None, pattern: str | None) -> Encoder:
    if (path, ranks) not in _encoders:
        _encoders[path, ranks] = Encoder(path, ranks, pattern)
    return _encoders[path, ranks]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of n ids; only the first may be shorter."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((start, capacity) for start in range(first, n, capacity))]


def tokenized(
    df: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None,
    key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END,
) -> DataFrame:
    """One row per piece: ``key, piece, start, length, ids`` (little-endian unsigned 32-bit).

    ``split`` and ``nth`` tell pieces of equal length apart: the task that made a piece, and
    how many of its length that task had made before.  Written, so that both stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer, ranks, pattern)
        split = TaskContext.get().partitionId()
        made = np.zeros(capacity + 1, np.int64)
        tail = np.array([end], "<u4")
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                row, piece, start, length, ids, nth = [], [], [], [], [], []
                for i, value in enumerate(batch.column("text")):
                    tokens = np.concatenate([encode.ids(value.as_py() or ""), tail])
                    for number, (a, n) in enumerate(cuts(len(tokens), capacity)):
                        row.append(i)
                        piece.append(number)
                        start.append(a)
                        length.append(n)
                        ids.append(tokens[a : a + n].tobytes())
                        nth.append(made[n])
                        made[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(pa.array(row, pa.int64())),
                        pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                        pa.array(ids, pa.binary()), pa.array([split] * len(row), pa.int32()), pa.array(nth, pa.int64()),
                    ],
                    names=["key", "piece", "start", "length", "ids", "split", "nth"],
                )

    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(docs.dtypes)["key"]
    schema = f"key {kind}, piece int, start long, length long, ids binary, split int, nth long"
    return stored(docs.mapInArrow(run, schema), "packing-pieces").withColumnRenamed("key", key)


class Plan:
    """Which sequence and offset the pieces of each length get, by rank.

    A row ``(length, rank, sequence, each, offset)`` says: the pieces of that length from that
    rank on go ``each`` to a sequence, from that sequence on, from that offset on.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.used: dict[int, int] = {}
        self.sequences = 0

    def put(self, length: int, count: int, sequence: int, each: int, offset: int) -> None:
        rank = self.used.get(length, 0)
        self.rows.append((length, rank, sequence, each, offset))
        self.used[length] = rank + count

    def fix(self, lengths: list[int], times: int) -> None:
        """``times`` sequences of the given pieces, closed."""
        offset = 0
        for length in dict.fromkeys(lengths):
            each = lengths.count(length)
            self.put(length, times * each, self.sequences, each, offset)
            offset += length * each
        self.sequences += times


def _dominating(j: int, sizes: list[int], counts: dict[int, int], capacity: int) -> list[int] | None:
    """A set with j that dominates every feasible set with j, or None.

    ``sizes``: the open lengths, rising; one piece of length j is set aside.
    """
    room = capacity - j
    left = lambda x: counts[x] - (x == j)
    small: list[int] = []  # the three smallest other pieces
    for x in sizes:
        small += [x] * min(left(x), 3 - len(small))
        if len(small) == 3:
            break
    if not small or small[0] > room:
        return [j]
    at = bisect.bisect_right(sizes, room) - 1
    while left(sizes[at]) == 0:
        at -= 1
    k = sizes[at]
    if k == room or len(small) < 2 or small[0] + small[1] > room:
        return [j, k]
    if len(small) == 3 and sum(small) <= room:
        return None
    # At most two more pieces fit: the best pair, its larger piece first.
    best = (0, 0)
    low = 0
    for high in range(at, -1, -1):
        a = sizes[high]
        if left(a) == 0:
            continue
        while low < high and sizes[low] + a <= room:
            low += 1
        for b in (sizes[x] for x in range(min(low, high), -1, -1)):
            if left(b) - (a == b) > 0 and a + b <= room:
                best = max(best, (a + b, a))
                break
        if low >= high and 2 * a <= room:
            break
    total, a = best
    if k >= total:
        return [j, k]
    b = total - a
    if a != k:
        return None
    # No two pieces longer than b fit with j, so every other pair fits piece by piece.
    longer: list[int] = []
    for x in sizes[bisect.bisect_right(sizes, b) :]:
        longer += [x] * min(left(x), 2 - len(longer))
        if len(longer) == 2:
            break
    if len(longer) < 2 or sum(longer) > room:
        return [j, a, b]
    return None


def reduce(counts: dict[int, int], plan: Plan) -> int:
    """Fix dominating sets until none is found; takes them out of ``counts``."""
    before = plan.sequences
    changed = True
    while changed:
        changed = False
        for j in sorted(counts, reverse=True):
            while counts.get(j):
                found = _dominating(j, sorted(counts), counts, plan.capacity)
                if found is None:
                    break
                times = min(counts[x] // found.count(x) for x in found)
                plan.fix(found, times)
                for x in dict.fromkeys(found):
                    counts[x] -= times * found.count(x)
                    if not counts[x]:
                        del counts[x]
                changed = True
    return plan.sequences - before


def best_fit(counts: dict[int, int], plan: Plan) -> None:
    """Longest pieces first, each where it leaves least room, whole groups at once."""
    open_: dict[int, list[tuple[int, int]]] = {}  # room: groups (first sequence, how many)
    rooms: list[int] = []

    def add(room: int, first: int, many: int) -> None:
        if many and room:
            if room not in open_:
                bisect.insort(rooms, room)
                open_[room] = []
            open_[room].append((first, many))

    def fill(length: int, count: int, first: int, many: int, room: int) -> int:
        """Put pieces into a group, as many to a sequence as fit; returns what is left."""
        each = room // length
        full = min(many, count // each)
        if full:
            plan.put(length, full * each, first, each, plan.capacity - room)
            add(room - each * length, first, full)
        rest = min(count - full * each, each) if full < many else 0
        if rest:
            plan.put(length, rest, first + full, rest, plan.capacity - room)
            add(room - rest * length, first + full, 1)
        add(room, first + full + bool(rest), many - full - bool(rest))
        return count - full * each - rest

    for length in sorted(counts, reverse=True):
        count = counts[length]
        while count:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                many = -(-count // (plan.capacity // length))
                first, plan.sequences = plan.sequences, plan.sequences + many
                count = fill(length, count, first, many, plan.capacity)
                continue
            room = rooms[at]
            groups = open_[room]
            first, many = groups.pop()
            if not groups:
                del open_[room]
                rooms.pop(at)
            count = fill(length, count, first, many, room)


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    plan, rest = Plan(capacity), {k: v for k, v in counts.items() if v}
    reduce(rest, plan)
    best_fit(rest, plan)
    return plan


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces; ``split`` and ``nth`` go.

    Other columns of ``pieces`` are carried through one shuffle, so drop wide ones first.
    """
    counts = pieces.groupBy("split", "length").agg((F.max("nth") + 1).alias("made"))
    counts = stored(counts, "packing-counts")
    total = counts.groupBy("length").agg(F.sum("made")).collect()
    plan = solve({int(length): int(n) for length, n in total}, capacity)
    rows = np.array(sorted(plan.rows), np.int64).reshape(-1, 5)
    shared = pieces.sparkSession.sparkContext.broadcast((rows[:, 0] << 48 | rows[:, 1], rows))

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        starts, rows = shared.value
        length, rank = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        row = rows[np.searchsorted(starts, length << 48 | rank, side="right") - 1]
        nth = rank - row[:, 1]
        return pa.StructArray.from_arrays(
            [pa.array(row[:, 2] + nth // row[:, 3]), pa.array(row[:, 4] + nth % row[:, 3] * length)],
            ["sequence_id", "offset"],
        )

    before = Window.partitionBy("length").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("split", "length", F.coalesce(F.sum("made").over(before), F.lit(0)).alias("base"))
    out = pieces.join(base, ["split", "length"]).withColumn("place", place("length", F.col("base") + F.col("nth")))
    kept = [c for c in pieces.columns if c not in ("split", "nth")]
    return out.select(*kept, "place.sequence_id", "place.offset")
