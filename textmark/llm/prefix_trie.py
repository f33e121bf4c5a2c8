"""The prefix trie of conversations, by a splitter skeleton and sorted shards.

A node is a sequence of turns that some conversation begins with; its members are the
conversations that do.

1. A conversation becomes its *path*: 16 bytes per turn, a digest of role and text.  Paths
   sort so that the members of a node stand together.
2. *Splitters* cut the order of ``(path, conversation)`` into shards; they are quantiles of
   a sample drawn by hash.  A node whose members lie in several shards is a prefix of a
   splitter's path, so the trie of these paths, the *skeleton*, holds every such node.  The
   skeleton is broadcast; its size is checked, and fewer splitters are taken if it does not
   fit.  Copies of one path are told apart by their conversation, so a path that a third of
   all conversations share is cut like any other.
3. A shard is read in order with one stack of open nodes.  Nodes outside the skeleton are
   finished there; of skeleton nodes the shard gives a partial aggregate over what it saw.
4. Partial aggregates are reduced by node; the skeleton, bounded as above, is then rolled up
   from its leaves to the root.

The ids of conversations that end at a skeleton node travel as text of up to ``TEXT_BYTES``
per row, in order, so their hash is computed over few rows and never over a gathered list.

Defined results: turns are ordered by number, nulls first, ties by the first ``TIED``
characters of role and text and then by digest; a null role or text is empty; rows with a
null conversation take no part; a repeated row is a turn of its own; a conversation without
turns is a member of the root; without conversations there is no node; other columns are not
read.  A conversation's digests (20 bytes a turn) must fit a task; texts are never gathered.
"""

from __future__ import annotations

import bisect
import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmark.llm.frames import stored

STEP = 16
TIED = 32
#: Turns of a shard, sampled paths per splitter, and bytes that the skeleton may take.
SHARD_TURNS = 10_000
SAMPLED = 8
SKELETON_BYTES = 16 << 20
TEXT_BYTES = 1 << 16
HEADS = 5


def turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, pos, step, length)``: turns with their place from 1, digest and code points."""
    role_, text_ = (F.coalesce(F.col(x), F.lit("")) for x in (role, text))
    step = F.md5(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.substring(role_, 1, TIED).alias("r"), F.substring(text_, 1, TIED).alias("t"),
        step.alias("step"), F.length(text_).alias("length"),
    )
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "r", "t", "step")
    return rows.select("conv", F.row_number().over(order).alias("pos"), "step", "length")


def _joined(rows: Column) -> Column:
    """The path of an array of ``(pos, step, length)``."""
    return F.unhex(F.array_join(F.transform(rows, lambda x: x["step"]), ""))


def paths(rows: DataFrame) -> DataFrame:
    """``(conv, path, lengths)`` of conversations as they are."""
    of = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("pos", "step", "length"))).alias("x"))
    return of.select("conv", _joined(F.col("x")).alias("path"), F.transform("x", lambda x: x["length"]).alias("lengths"))


def rebuilt(rows: DataFrame, base: Column, taken: Column, heads: int = HEADS) -> DataFrame:
    """``(conv, path, lengths)``: the first ``taken`` turns of ``base``, then one's own behind as many.

    Both are columns of ``conv``; ``taken`` is at most ``heads``.  Only the turns of bases are
    shuffled once more, ``heads`` of each at most.
    """
    own = rows.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("pos", "step", "length"))).alias("x")
    ).select("conv", base.cast("long").alias("base"), taken.cast("int").alias("h"), "x")
    first = own.where("conv = base").select(F.col("conv").alias("base"), F.slice("x", 1, heads).alias("first"))
    both = own.join(first, "base", "left")
    none = F.array().cast("array<struct<pos:int,step:string,length:int>>")
    head = F.slice(F.coalesce("first", none), F.lit(1), F.col("h"))
    both = both.select("conv", F.concat(head, F.expr("slice(x, h + 1, greatest(size(x) - h, 0))")).alias("x"))
    return both.select("conv", _joined(F.col("x")).alias("path"), F.transform("x", lambda x: x["length"]).alias("lengths"))


class Skeleton:
    """The trie of the splitters' paths; node 0 is the root."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = sorted(splitters)
        self.children: dict[tuple[int, bytes], int] = {}
        self.parent = [-1]
        for path, _ in self.splitters:
            node = 0
            for at in range(0, len(path), STEP):
                key = node, path[at : at + STEP]
                if key not in self.children:
                    self.children[key] = len(self.parent)
                    self.parent.append(node)
                node = self.children[key]

    def shard(self, path: bytes, conv: int) -> int:
        return bisect.bisect_right(self.splitters, (path, conv))


def skeleton(of: DataFrame, shard_turns: int = SHARD_TURNS, most: int = SKELETON_BYTES) -> Skeleton:
    """Splitters for shards of about ``shard_turns`` turns, whose paths take ``most`` bytes at most.

    A shard holds more turns only if the splitters' paths would not fit; a path of more than
    a sixteenth of that is no splitter.
    """
    size = of.agg(F.count("*").alias("n"), F.sum(F.size("lengths") + 1).alias("turns")).first()
    splits = max(0, -(-(size["turns"] or 0) // shard_turns) - 1)
    chance = F.pmod(F.xxhash64(F.lit("splitter"), "conv"), F.lit(1 << 40))
    while splits:
        share = min(1 << 40, -(-(splits + 1) * SAMPLED * (1 << 40) // size["n"]))
        asked = of.where((chance < F.lit(share)) & (F.length("path") * 16 <= most))
        if (asked.agg(F.sum(F.length("path") + 8)).first()[0] or 0) <= most:
            rows = sorted((bytes(x["path"]), x["conv"]) for x in asked.select("path", "conv").toArrow().to_pylist())
            if rows:
                return Skeleton(sorted({rows[(i + 1) * len(rows) // (splits + 1)] for i in range(splits)}))
        splits //= 2
    return Skeleton([])


#: kind 0: a finished node, below skeleton node ``node`` if its parent is not given; 1: a partial aggregate of skeleton node ``node``; 2: ids that end there.
_ROWS = pa.schema(
    [("kind", pa.int8()), ("node", pa.int64()), ("shard", pa.int64()), ("nth", pa.int64()), ("conv_id", pa.int64()),
     ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
     ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("length", pa.int64()), ("ends", pa.string())]
)
_DDL = (
    "kind byte, node long, shard long, nth long, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, length long, ends string"
)
_EMPTY = hashlib.sha256(b"").hexdigest()
_NUMBERS = 6


class _Open:
    """A node whose members are being read."""

    __slots__ = ("skeleton", "length", "least", "n", "children", "leaves", "saved", "hash", "text", "size", "nth", "numbers", "hashes")

    def __init__(self, skeleton: int | None, length: int):
        self.skeleton, self.length = skeleton, length
        self.least, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.hash, self.text, self.size, self.nth = None, [], 0, 0
        # Finished children, which still wait for the smallest member of this node.
        self.numbers, self.hashes = array("q"), []


class _Shard:
    """One pass over the sorted rows of a shard."""

    def __init__(self, skeleton: Skeleton, number: int, out: list[tuple]):
        self.skeleton, self.number, self.out = skeleton, number, out
        self.stack = [_Open(0, 0)]
        self.path = b""

    def add(self, path: bytes, conv: int, lengths) -> None:
        if path != self.path:
            same = 0
            most = min(len(path), len(self.path))
            while same < most and path[same : same + STEP] == self.path[same : same + STEP]:
                same += STEP
            while (len(self.stack) - 1) * STEP > same:
                self.close()
            for depth in range(same // STEP, len(path) // STEP):
                above = self.stack[-1].skeleton
                key = path[depth * STEP : (depth + 1) * STEP]
                known = None if above is None else self.skeleton.children.get((above, key))
                self.stack.append(_Open(known, lengths[depth]))
            self.path = path
        node = self.stack[-1]
        node.n += 1
        node.least = conv if node.least is None else min(node.least, conv)
        if node.skeleton is None:
            if node.hash is None:
                node.hash = hashlib.sha256(str(conv).encode())
            else:
                node.hash.update(f",{conv}".encode())
        else:
            node.text.append(str(conv))
            node.size += len(node.text[-1]) + 1
            if node.size >= TEXT_BYTES:
                self._say(node)

    def _say(self, node: _Open) -> None:
        if node.text:
            self.out.append((2, node.skeleton, self.number, node.nth, *[None] * 8, ",".join(node.text)))
            node.text, node.size, node.nth = [], 0, node.nth + 1

    def close(self) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        above = self.stack[-1] if self.stack else None
        if above is not None:
            above.n += node.n
            above.least = node.least if above.least is None else min(above.least, node.least)
        if node.skeleton is not None:
            self._say(node)
            self.out.append(
                (1, node.skeleton, self.number, None, node.least, depth, None, node.n, node.children, node.leaves, node.saved, node.length, None)
            )
            return
        # Its children waited for its smallest member; itself it waits only in the shard.
        for i, ends in enumerate(node.hashes):
            self._done(None, node.least, node.numbers[i * _NUMBERS : (i + 1) * _NUMBERS], ends)
        leaves = node.leaves or 1
        saved = node.saved + (node.n - 1) * node.length
        ends = _EMPTY if node.hash is None else node.hash.hexdigest()
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        numbers = (node.least, depth, node.n, node.children, leaves, saved)
        if above.skeleton is None:
            above.numbers.extend(numbers)
            above.hashes.append(ends)
        else:
            self._done(above.skeleton, None, numbers, ends)

    def _done(self, above: int | None, parent: int | None, x, ends: str) -> None:
        self.out.append((0, above, None, None, x[0], x[1], parent, x[2], x[3], x[4], x[5], None, ends))

    def end(self) -> None:
        while self.stack:
            self.close()


def _local(skeleton, flush: int = 20_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bones: Skeleton = skeleton.value
        shard: _Shard | None = None
        out: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _ROWS, strict=True)]
            return pa.RecordBatch.from_arrays(columns, schema=_ROWS)

        for batch in batches:
            for number, path, conv, lengths in zip(*(batch.column(x).to_pylist() for x in ("shard", "path", "conv", "lengths")), strict=True):
                if shard is None or shard.number != number:
                    if shard is not None:
                        shard.end()
                    shard = _Shard(bones, number, out)
                shard.add(path, conv, lengths)
                if len(out) >= flush:
                    yield batch_of(out)
                    out.clear()
        if shard is not None:
            shard.end()
        for at in range(0, len(out), flush):
            yield batch_of(out[at : at + flush])

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the texts of each node, which come in order, joined by commas."""
    node, digest = None, None
    for batch in batches:
        done = []
        for key, text in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if key != node:
                if digest is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_pydict({"node": [x[0] for x in done], "ends": [x[1] for x in done]})
    if digest is not None:
        yield pa.RecordBatch.from_pydict({"node": [node], "ends": [digest.hexdigest()]})


_NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _rolled(bones: Skeleton, parts: list[dict]) -> list[tuple]:
    """Rows of the skeleton's nodes, and their number, from the reduced partial aggregates."""
    of = {x["node"]: x for x in parts}
    n = len(bones.parent)
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for node in range(n - 1, -1, -1):  # a child has a larger number than its parent
        x = of.get(node)
        if x is None:
            continue
        children[node] += x["n_children"]
        leaves[node] += x["n_leaves"]
        saved[node] += x["saved_tokens"] + (x["n_convs"] - 1) * x["length"]
        if children[node] == 0:
            leaves[node] = 1
        above = bones.parent[node]
        if above >= 0:
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
    return [
        (node, x["conv_id"], x["depth"], of[bones.parent[node]]["conv_id"] if node else None, x["n_convs"],
         children[node], leaves[node], saved[node], x["ends"] or _EMPTY)
        for node, x in of.items()
    ]


def trie(of: DataFrame, shard_turns: int = SHARD_TURNS, most: int = SKELETON_BYTES) -> DataFrame:
    """One row per node of the trie of ``of(conv, path, lengths)``, conv unique: ``_NODES``."""
    spark = of.sparkSession
    of = stored(of, "trie-paths")
    bones = skeleton(of, shard_turns, most)
    shared = spark.sparkContext.broadcast(bones)

    @F.arrow_udf("long")
    def shard(path: pa.Array, conv: pa.Array) -> pa.Array:
        return pa.array([shared.value.shard(p, c) for p, c in zip(path.to_pylist(), conv.to_pylist(), strict=True)], pa.int64())

    rows = of.select(shard("path", "conv").alias("shard"), "path", "conv", "lengths")
    rows = rows.repartition(len(bones.splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv")
    rows = stored(rows.mapInArrow(_local(shared), _DDL), "trie-rows")

    ends = rows.where("kind = 2").select("node", "shard", "nth", "ends").repartition("node")
    ends = ends.sortWithinPartitions("node", "shard", "nth").mapInArrow(_hashed, "node long, ends string")
    parts = rows.where("kind = 1").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("length").alias("length"),
        *[F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    # As many rows as the skeleton has nodes, whose size was checked.
    found = _rolled(bones, parts.join(ends, "node", "left").toArrow().to_pylist())
    top = spark.createDataFrame(found, "node long, " + _NODES)
    names = F.broadcast(top.select("node", F.col("conv_id").alias("above")))
    done = rows.where("kind = 0").join(names, "node", "left")
    done = done.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).withColumnRenamed("ends", "ends_sha256")
    columns = [x.split()[0] for x in _NODES.split(", ")]
    return done.select(*columns).union(top.select(*columns))
