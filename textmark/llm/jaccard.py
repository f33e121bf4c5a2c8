"""Documents whose sets of word shingles overlap, found with signature trees.

A document is the set of its distinct 5-word shingles.  Two documents link when
``100 * intersection >= percent * union``.  The search is exact:

1. Sets are hashed from whole texts; equal sets become one node.
2. Two sets that link share one of their first ``n - ceil(n * percent / 100) + 1``
   shingles, in any one order of all shingles.  The order is that of their hashes, but
   shingles that are frequent in one of ``SPARSE`` documents come last: a passage that
   very many documents share then makes no bucket of theirs.  The order decides only how
   much is compared, never what links.  Each shingle that several nodes have there is a bucket;
   buckets with the same nodes are searched once.  Nodes are also split by set size, so
   that only sizes that can link meet.
3. Each bucket is a signature tree: leaves hold the bitmap, size and bit collisions of a
   set, nodes above hold the OR of the bitmaps and the range of sizes.  Two trees are
   walked together; a pair of nodes is left when the largest overlap that its bitmaps and
   sizes permit is too small.  A bucket larger than a block is walked block by block.
4. First the buckets of each node's ``SEEDS`` lowest shared shingles propose pairs, only as
   many as join their nodes and the most similar bitmaps first.  These are compared shingle
   by shingle and make components, which hold most links.
5. Then all buckets are searched, with one row per component in place of its nodes: itself
   a node of a signature tree, the OR of their bitmaps.  A component that may hold a link
   with a larger one asks for it, and the nodes of both are compared by whole sets.
6. In buckets of more than ``OPEN`` components each asks only for the largest one that it may
   link with, answers contract the components, and this is repeated while it joins many.
   Only then are all remaining pairs asked.  A group of m near copies that hang together so
   costs rows in proportion to m, however many of its pairs link and however many shingles
   they share.

Defined results: null, empty and wordless texts have no shingles and link with nothing;
a text of one to four words is one shingle; a null key gets no component and links
nothing; rows with equal keys and texts get equal rows; other columns are not read.
Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmark.llm import words as W
from textmark.llm.frames import components, narrowed, small_batches, stored
from textmark.operators.lookup import fits_broadcast

SHINGLE = 5
PERCENT = 75
SEEDS = 4
#: One document in so many is asked which shingles are frequent, and how many may be listed.
SPARSE = 32
FREQUENT = 4
LISTED = 20_000
#: Components of a bucket from which on each asks for one other at a time, and the share of
#: them that a round may leave if another one is to follow.
OPEN = 32
STILL = 0.8
#: Tasks over which the buckets of one group are dealt, and pairs a task remembers.
LANES = 8
REMEMBERED = 500_000
BLOCK = 2048
LEAF = 16
FANOUT = 8

_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def shingle_sets(words: W.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in (text, hash) order, and how many per text."""
    texts = len(words.counts)
    at = W.whole_grams(words, k)
    hashes, owner = W.grams(words.hashes, k)[at], words.text[at]
    for length in range(1, k):
        short = np.flatnonzero(words.counts == length)
        if len(short):
            hashes = np.append(hashes, _grams_at(words, short, length))
            owner = np.append(owner, short)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[new], owner[new]
    return hashes, np.bincount(owner, minlength=texts)


def _grams_at(words: W.Words, texts: np.ndarray, length: int) -> np.ndarray:
    runs = words.hashes[(words.first[texts][:, None] + np.arange(length)).ravel()]
    return W.grams(runs, length)[::length]


def size_class(n):
    """Sets of class c have 2^c to 2^(c+1) - 1 shingles."""
    return np.frexp(n)[1] - 1


def bits_of(cls: int) -> int:
    return 1 << max(6, int(cls) + 2)


def node_ids(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each set, 0 for empty ones."""
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(W.mix(hashes), out=total[1:])
    end = np.cumsum(counts)
    ids = W.mix((total[end] - total[end - counts]) ^ (counts.astype(np.uint64) << np.uint64(40)))
    return np.where(counts > 0, ids, 0).astype(np.uint64).view(np.int64)


_SETS = "key long, n long, node long, bitmap binary, tokens array<long>"


def _frequent(docs: DataFrame, k: int) -> np.ndarray:
    """Sorted shingles that several of the asked documents hold; a bounded list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.zeros(0, np.uint64)]
            for _, _, data, offsets in W.chunks(batch.column("text")):
                held.append(shingle_sets(W.words_of(data, offsets, W.NOT_SPACE), k)[0])
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n)], names=["token", "n"])

    asked = docs.where(F.pmod(F.xxhash64("text"), F.lit(SPARSE)) == 0).select("text").distinct()
    counts = asked.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counts = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "token").limit(LISTED).toArrow()
    return np.sort(counts["token"].to_numpy().view(np.uint64))


def _last(hashes: np.ndarray, n: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Shingles of each text in order, frequent ones behind the others."""
    if len(frequent) == 0 or len(hashes) == 0:
        return hashes
    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    return hashes[np.lexsort((frequent[at] == hashes, np.repeat(np.arange(len(n)), n)))]


def _sets(k: int, percent: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies in one split need their shingles once
        for batch in batches:
            keyed = batch.column("key").is_valid().to_numpy(zero_copy_only=False)
            for start, stop, data, offsets in W.chunks(batch.column("text")):
                words = W.words_of(data, offsets, W.NOT_SPACE)
                hashes, n = shingle_sets(words, k)
                nodes = node_ids(hashes, n)
                first = np.cumsum(n) - n
                bitmaps: list[bytes | None] = []
                new = np.zeros(len(n), bool)
                for i, node in enumerate(nodes.tolist()):
                    # A row without a key links nothing and must not stand for copies that do.
                    if n[i] == 0 or node in seen or not keyed[start + i]:
                        bitmaps.append(None)
                        continue
                    seen.add(node)
                    new[i] = True
                    bits = bits_of(size_class(n[i]))
                    map_ = np.zeros(bits, bool)
                    map_[(hashes[first[i] : first[i] + n[i]] >> np.uint64(17)) & np.uint64(bits - 1)] = True
                    bitmaps.append(np.packbits(map_).tobytes())
                hashes = _last(hashes, n, shared.value)
                prefix = np.where(new, n - (n * percent + 99) // 100 + 1, 0)
                text = np.repeat(np.arange(len(n)), n)
                chosen = np.arange(len(hashes)) - first[text] < prefix[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(start, stop - start),
                        pa.array(n, pa.int64()),
                        pa.array(nodes),
                        pa.array(bitmaps, pa.binary()),
                        W.list_array(pa.array(hashes[chosen].view(np.int64)), prefix),
                    ],
                    names=["key", "n", "node", "bitmap", "tokens"],
                )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(token, node)`` sorted by both, without copies and lonely tokens."""
    held = None  # the first row of a token that nothing was seen beside yet
    last = None
    for batch in batches:
        token = batch.column("token").to_numpy()
        node = batch.column("node").to_numpy()
        if held is not None:
            token, node = np.append(held[0], token), np.append(held[1], node)
        n = len(token)
        if n == 0:
            continue
        new = np.ones(n, bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        if held is None and last is not None and last == (token[0], node[0]):
            new[0] = False
        token, node = token[new], node[new]
        n = len(token)
        if n == 0:
            continue
        beside = np.zeros(n, bool)
        beside[1:] |= token[1:] == token[:-1]
        beside[:-1] |= token[1:] == token[:-1]
        if last is not None and held is None and last[0] == token[0]:
            beside[0] = True
        last = (token[-1], node[-1])
        held = None
        if not beside[-1]:
            held = last
        token, node = token[beside], node[beside]
        if len(token):
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(node)], names=["token", "node"])


class Tree:
    """Levels of a signature tree, leaves first; each level halves little and ORs much."""

    def __init__(self, maps: np.ndarray, low: np.ndarray, high: np.ndarray, extra: np.ndarray):
        self.maps, self.low, self.high, self.extra = [maps], [low], [high], [extra]
        step = LEAF
        while len(self.maps[-1]) > 1:
            cuts = np.arange(0, len(self.maps[-1]), step)
            self.maps.append(np.bitwise_or.reduceat(self.maps[-1], cuts, axis=0))
            self.low.append(np.minimum.reduceat(self.low[-1], cuts))
            self.high.append(np.maximum.reduceat(self.high[-1], cuts))
            self.extra.append(np.maximum.reduceat(self.extra[-1], cuts))
            step = FANOUT


def _popcount(maps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(maps).sum(axis=1, dtype=np.int64)


def _possible(left: Tree, right: Tree, up: int, low: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets below nodes a and b may link, by size range and largest overlap."""
    a_low, a_high, b_low, b_high = left.low[up][a], left.high[up][a], right.low[low][b], right.high[low][b]
    fits = (a_high * 100 >= b_low * percent) & (b_high * 100 >= a_low * percent)
    need = (a_low + b_low) * percent  # over 100 + percent: the overlap the smallest sets need
    out = fits
    at = np.flatnonzero(fits)
    for s in range(0, len(at), 1 << 14):
        c = at[s : s + (1 << 14)]
        most = _popcount(left.maps[up][a[c]] & right.maps[low][b[c]])
        most += np.minimum(left.extra[up][a[c]], right.extra[low][b[c]])
        out[c] = most * (100 + percent) >= need[c]
    return out


def walk(left: Tree, right: Tree, same: bool, percent: int, open_) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of leaves that no bound rules out, a few thousand at a time.

    Depth first, so that the list of waiting pairs stays short.  ``open_`` tells which pairs
    of leaves are worth looking at.
    """
    heap = [(len(left.maps) - 1, len(right.maps) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    if len(left.maps) == 1 and len(right.maps) == 1 and same:
        return  # a single set
    while heap:
        i, j, a, b = heap.pop()
        if i == 0 and j == 0:
            keep = open_(a, b)
            a, b = a[keep], b[keep]
        keep = _possible(left, right, i, j, a, b, percent)
        a, b = a[keep], b[keep]
        if len(a) == 0:
            continue
        if i == 0 and j == 0:
            yield a, b
            continue
        a, b, i2, j2 = _children(left, right, i, j, a, b)
        if same:
            # Both sides stand on the same level, so pairs are wanted once.
            keep = a <= b if i2 or j2 else a < b
            a, b = a[keep], b[keep]
        for s in range(0, len(a), 1 << 13):
            heap.append((i2, j2, a[s : s + (1 << 13)], b[s : s + (1 << 13)]))


def _alike(maps: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of bitmaps, as a guess at that of the sets."""
    out = np.empty(len(a))
    for s in range(0, len(a), 1 << 14):
        x, y = maps[a[s : s + (1 << 14)]], maps[b[s : s + (1 << 14)]]
        out[s : s + (1 << 14)] = _popcount(x & y) / np.maximum(_popcount(x | y), 1)
    return out


def _children(left: Tree, right: Tree, i: int, j: int, a: np.ndarray, b: np.ndarray):
    """All pairs of children, of the side that stands higher or of both."""
    down_a, down_b = i >= j, j >= i
    if down_a:
        a, b = _expand(a, b, LEAF if i == 1 else FANOUT, len(left.maps[i - 1]))
        i -= 1
    if down_b:
        b, a = _expand(b, a, LEAF if j == 1 else FANOUT, len(right.maps[j - 1]))
        j -= 1
    return a, b, i, j


def _expand(a: np.ndarray, b: np.ndarray, step: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    child = (a[:, None] * step + np.arange(step)).ravel()
    b = np.repeat(b, step)
    keep = child < size
    return child[keep], b[keep]


def _bitmaps(array: pa.Array, width: int) -> np.ndarray:
    """Bitmaps as rows of ``width`` 64-bit numbers.

    Bits stand in hash order modulo the size, so the halves of a bitmap twice as wide are
    laid onto each other.
    """
    array = array.cast(pa.large_binary())
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1] // 8
    data = np.frombuffer(data, np.uint64, offsets[-1])
    out = data[offsets[:-1][:, None] + np.arange(width)]
    wide = np.flatnonzero(np.diff(offsets) > width)
    out[wide] |= data[offsets[:-1][wide][:, None] + np.arange(width, 2 * width)]
    return out


class Unions:
    """Which rows are joined already; ``root`` holds a label per row."""

    def __init__(self, root: np.ndarray):
        self.up: dict[int, int] = {}
        self.root = root

    def of(self, row: int) -> int:
        x = int(self.root[row])
        while x in self.up:
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        x, y = self.of(a), self.of(b)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _forest(a: np.ndarray, b: np.ndarray, root: np.ndarray) -> tuple[list[int], list[int]]:
    unions, out_a, out_b = Unions(root), [], []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        if unions.join(x, y):
            out_a.append(x)
            out_b.append(y)
    return out_a, out_b


#: Pairs of rows, as lists: proposals, or pairs across components.
Pairs = tuple[list[int], list[int]]


#: Columns of the leaves: bitmaps, least and largest size, and most bit collisions.
Leaves = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _trees(leaves: Leaves, left, right) -> tuple[Tree, Tree, np.ndarray, np.ndarray, bool] | None:
    la, ra = np.flatnonzero(left), np.flatnonzero(right)
    if len(la) == 0 or len(ra) == 0:
        return None
    same = len(la) == len(ra) and bool((la == ra).all())
    one = Tree(*(x[la] for x in leaves))
    return one, one if same else Tree(*(x[ra] for x in leaves)), la, ra, same


def _joining(leaves: Leaves, root, left, right, percent: int) -> Pairs:
    """Pairs that join the rows of a unit, likely ones first, as if each linked."""
    out_a: list[int] = []
    out_b: list[int] = []
    trees = _trees(leaves, left, right)
    if trees is None:
        return out_a, out_b
    maps = leaves[0]
    one, other, la, ra, same = trees
    root = root.copy()
    for least in (0.7, 0.55, 0.4, 0.0):
        for a, b in walk(one, other, same, percent, lambda a, b: root[la[a]] != root[ra[b]]):
            a, b = la[a], ra[b]
            if least:
                likely = _alike(maps, a, b) >= least
                a, b = a[likely], b[likely]
            while True:
                open_ = root[a] != root[b]
                a, b = a[open_], b[open_]
                if len(a) == 0:
                    break
                _, first = np.unique(root[a], return_index=True)  # one pair per root at once
                for x, y in zip(a[first].tolist(), b[first].tolist(), strict=True):
                    if root[x] != root[y]:
                        out_a.append(x)
                        out_b.append(y)
                        root[root == root[x]] = root[y]
    return out_a, out_b


def _leaf_pairs(start, size, leaves: Leaves, root, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Possible pairs, and their unit, of units of a few leaves, which need no tree: many at once."""
    pairs_a, pairs_b = [], []
    for m in np.unique(size):
        x, y = np.triu_indices(m, 1)
        base = start[size == m][:, None]
        pairs_a.append((base + x).ravel())
        pairs_b.append((base + y).ravel())
    a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
    open_ = root[a] != root[b]
    a, b = a[open_], b[open_]
    flat = Tree.__new__(Tree)
    flat.maps, flat.low, flat.high, flat.extra = ([x] for x in leaves)
    keep = _possible(flat, flat, 0, 0, a, b, percent)
    a, b = a[keep], b[keep]
    return a, b, np.searchsorted(start, a, side="right") - 1


def _joining_leaves(start, size, leaves: Leaves, root, percent: int) -> Pairs:
    a, b, unit = _leaf_pairs(start, size, leaves, root, percent)
    order = np.lexsort((-_alike(leaves[0], a, b), unit))
    a, b, unit = a[order], b[order], unit[order]
    out_a: list[int] = []
    out_b: list[int] = []
    # A node stands in many buckets: each has its own joins.
    cuts = np.append(np.flatnonzero(np.append(True, unit[1:] != unit[:-1])), len(unit)) if len(unit) else []
    for at, end in zip(cuts[:-1], cuts[1:], strict=True):
        x, y = _forest(a[at:end], b[at:end], root)
        out_a += x
        out_b += y
    return out_a, out_b


SMALL = 2 * LEAF
_UNIT = ["cls", "token", "i", "j"]


def _by_unit(columns: list[str], flush):
    """Give ``flush`` tables of whole units of a partition that is sorted by ``columns``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            first, last = ([x.column(c)[at].as_py() for c in columns] for x, at in ((held[0], 0), (batch, batch.num_rows - 1)))
            if first == last:
                continue
            rows = pa.Table.from_batches(held)
            same = np.ones(rows.num_rows, bool)
            for x, value in zip(columns, last, strict=True):
                same &= rows.column(x).to_numpy() == value
            cut = int(np.argmax(same))
            if cut:
                yield from flush(rows.slice(0, cut))
            held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield from flush(pa.Table.from_batches(held))

    return run


def _starts(columns: list[np.ndarray]) -> np.ndarray:
    edge = np.zeros(len(columns[0]), bool)
    edge[0] = True
    for x in columns:
        edge[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(edge)


class _Units:
    """Columns of whole units, and where the units of each class begin."""

    def __init__(self, rows: pa.Table):
        self.rows = rows
        self.unit = [rows.column(x).to_numpy() for x in _UNIT]
        self.node, self.low, self.high, self.extra = (rows.column(x).to_numpy() for x in ("node", "n", "high", "extra"))
        self.label = np.unique(self.node, return_inverse=True)[1]
        self.left, self.right = (rows.column(x).to_numpy(zero_copy_only=False) for x in ("left", "right"))
        self.start = _starts(self.unit)
        self.end = np.append(self.start[1:], len(self.node))
        self.small = (self.end - self.start <= SMALL) & np.logical_and.reduceat(self.left & self.right, self.start)

    def classes(self) -> Iterator[tuple[int, Leaves, np.ndarray]]:
        """``(first row, leaves, units)`` of each size class."""
        cls = self.unit[0][self.start]
        for c in np.unique(cls):
            of = np.flatnonzero(cls == c)
            lo, hi = self.start[of[0]], self.end[of[-1]]
            maps = _bitmaps(self.rows.column("bitmap").slice(lo, hi - lo), bits_of(c) // 64)
            low, extra = self.low[lo:hi], self.extra[lo:hi]
            yield lo, (maps, low, self.high[lo:hi], np.where(extra < 0, low - _popcount(maps), extra)), of


def _propose(percent: int):
    def flush(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        u = _Units(rows)
        for lo, leaves, of in u.classes():
            hi = lo + len(leaves[0])
            out_a: list[int] = []
            out_b: list[int] = []
            few = of[u.small[of]]
            if len(few):
                out_a, out_b = _joining_leaves(
                    u.start[few] - lo, (u.end - u.start)[few], leaves, u.label[lo:hi], percent
                )
            for g in of[~u.small[of]]:
                at = slice(u.start[g], u.end[g])
                s, e = u.start[g] - lo, u.end[g] - lo
                a, b = _joining(tuple(x[s:e] for x in leaves), u.label[at], u.left[at], u.right[at], percent)
                out_a += [x + s for x in a]
                out_b += [x + s for x in b]
            x, y = np.array(out_a, np.int64) + lo, np.array(out_b, np.int64) + lo
            if len(x):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.minimum(u.node[x], u.node[y])), pa.array(np.maximum(u.node[x], u.node[y])),
                    ],
                    names=["a", "b"],
                )

    return _by_unit(_UNIT, flush)


def _ask(percent: int, largest: bool = False):
    """Pairs of components ``(asker, root)`` that may hold a link; the smaller one asks.

    With ``largest`` every component asks in each unit for one other at most.
    """
    said: set[tuple[int, int]] = set()

    def flush(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        u = _Units(rows)
        size = rows.column("size").to_numpy()

        def asked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            down = (size[a] > size[b]) | ((size[a] == size[b]) & (u.node[a] > u.node[b]))
            asker, root = np.where(down, b, a), np.where(down, a, b)
            pairs = np.unique(np.stack([u.node[asker], -size[root] if largest else 0 * root, u.node[root]]), axis=1)
            if largest and pairs.shape[1]:
                pairs = pairs[:, np.append(True, pairs[0, 1:] != pairs[0, :-1])]
            return pairs[[0, 2]]

        found = [np.zeros((2, 0), np.int64)]
        for lo, leaves, of in u.classes():
            hi = lo + len(leaves[0])
            few = of[u.small[of]]
            if len(few):
                a, b, _ = _leaf_pairs(u.start[few] - lo, (u.end - u.start)[few], leaves, u.label[lo:hi], percent)
                found.append(asked(a + lo, b + lo))
            for g in of[~u.small[of]]:
                at, first = slice(u.start[g] - lo, u.end[g] - lo), u.start[g]
                label = u.label[u.start[g] : u.end[g]]
                trees = _trees(tuple(x[at] for x in leaves), u.left[u.start[g] : u.end[g]], u.right[u.start[g] : u.end[g]])
                if trees is None:
                    continue
                one, other, la, ra, same = trees
                pairs = [np.zeros((2, 0), np.int64)]
                for a, b in walk(one, other, same, percent, lambda a, b, x=label, la=la, ra=ra: x[la[a]] != x[ra[b]]):
                    pairs.append(asked(la[a] + first, ra[b] + first))
                if largest:  # of what the parts of the walk found
                    place = {int(n): i for i, n in zip(range(u.start[g], u.end[g]), u.node[u.start[g] : u.end[g]], strict=True)}
                    a, b = np.concatenate(pairs, axis=1)
                    at = [np.array([place[x] for x in side.tolist()], np.int64) for side in (a, b)]
                    pairs = [asked(*at)] if len(a) else pairs
                found += pairs
        pairs = set(zip(*np.concatenate(found, axis=1).tolist(), strict=True)) - said
        if len(said) + len(pairs) > REMEMBERED:
            said.clear()  # a pair may then be said again, which is harmless
        said.update(pairs)
        if pairs:
            asker, root = zip(*sorted(pairs), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(asker, pa.int64()), pa.array(root, pa.int64())], names=["asker", "root"])

    return _by_unit(_UNIT, flush)


_SUMMARY = "node long, cls int, n long, high long, extra long, bitmap binary, size long"
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]


def _united(most: int):
    """Rows of one component and class as one: OR of the bitmaps, range of sizes, most collisions.

    Holds ``most`` of them at a time; rows that come apart are united by a later pass over
    sorted rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}

        def flush() -> pa.RecordBatch:
            rows = [(*key, *x[:3], x[3].tobytes(), x[4]) for key, x in held.items()]
            held.clear()
            columns = zip(zip(*rows, strict=True), _KINDS, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in columns], names=batch.schema.names)

        for batch in batches:
            for node, cls, n, high, extra, bitmap, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                map_ = np.bitwise_or.reduce(np.frombuffer(bitmap, np.uint64).reshape(-1, bits_of(cls) // 64), axis=0)
                extra = n - int(np.bitwise_count(map_).sum()) if extra < 0 else extra
                x = held.get((node, cls))
                if x is None:
                    if len(held) >= most:
                        yield flush()
                    held[node, cls] = [n, high, extra, map_, size]
                else:
                    held[node, cls] = [min(x[0], n), max(x[1], high), max(x[2], extra), x[3] | map_, size]
        if held:
            yield flush()

    return run


def _summaries(members: DataFrame, classes) -> DataFrame:
    """``_SUMMARY`` of every component in each size class that its nodes are routed to."""
    rows = members.withColumn("cls", F.explode(classes))
    rows = rows.select(
        F.col("root").alias("node"), "cls", "n", F.col("n").alias("high"), F.lit(-1).cast("long").alias("extra"), "bitmap", "size"
    )
    # Copies of a large component unite in each task before they meet.
    several = rows.where("size > 1").mapInArrow(_united(4096), _SUMMARY)
    several = several.repartition("node", "cls").sortWithinPartitions("node", "cls").mapInArrow(_united(1), _SUMMARY)
    return rows.where("size = 1").union(several)


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """Each row once per pair of blocks of its bucket: columns i, j, left, right."""
    of = F.pmod(F.xxhash64("node"), F.col("parts"))
    pairs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    rows = rows.withColumn("parts", F.ceil(F.col("members") / block)).withColumn("mine", of)
    rows = rows.withColumn("other", pairs)
    rows = rows.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
    rows = rows.withColumn("left", F.col("mine") <= F.col("other"))
    rows = rows.withColumn("right", F.col("mine") >= F.col("other"))
    rows = rows.drop("members", "parts", "mine", "other")
    # Buckets of one group hold the same nodes: they go to a few tasks, each of which says
    # once what it finds in many of them.
    lane = F.pmod(F.xxhash64("token"), F.lit(LANES))
    return rows.repartition("least", "cls", lane, "i", "j").drop("least").sortWithinPartitions(*_UNIT, "n", "node")


#: Nodes of a component that are compared at once with as many that ask for it.
COMPARED = 256
_MEETING = ["comp", "i", "j"]


def _meet(k: int, percent: int):
    """Links between the nodes that ask for a component and its nodes, by whole sets."""

    def flush(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        start = _starts([rows.column(x).to_numpy() for x in _MEETING])
        for s, e in zip(start, np.append(start[1:], rows.num_rows), strict=True):
            unit = rows.slice(s, e - s)
            node = unit.column("node").to_numpy()
            asks = unit.column("asks").to_numpy(zero_copy_only=False)
            if asks.all() or not asks.any():
                continue
            data, offsets = W.text_bytes(unit.column("text"))
            hashes, n = shingle_sets(W.words_of(data, offsets, W.NOT_SPACE), k)
            a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
            common = _overlaps(hashes, n, a, b)
            x, y = np.nonzero(common * (100 + percent) >= (n[a][:, None] + n[b][None, :]) * percent)
            x, y = _forest(a[x], b[y], np.arange(len(node)))
            if x:
                yield pa.RecordBatch.from_arrays([pa.array(node[x]), pa.array(node[y])], names=["a", "b"])

    return _by_unit(_MEETING, flush)


def _overlaps(hashes: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 4096) -> np.ndarray:
    """Sizes of the intersections of sets a with sets b: products of their incidence matrices."""
    owner = np.repeat(np.arange(len(n)), n)
    side = np.zeros(len(n), bool)
    side[a] = True
    one = side[owner]
    shared = np.intersect1d(hashes[one], hashes[~one])
    at = np.searchsorted(shared, hashes)
    keep = (at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == hashes) if len(shared) else np.zeros(len(hashes), bool)
    at, owner = at[keep], owner[keep]
    place = np.zeros(len(n), np.int64)
    place[a], place[b] = np.arange(len(a)), np.arange(len(b))
    out = np.zeros((len(a), len(b)), np.float32)
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    for lo in range(0, len(shared), step):
        s, e = np.searchsorted(at, [lo, lo + step])
        col, row, left = at[s:e] - lo, place[owner[s:e]], side[owner[s:e]]
        x = np.zeros((len(a), step), np.float32)
        y = np.zeros((len(b), step), np.float32)
        x[row[left], col[left]] = 1
        y[row[~left], col[~left]] = 1
        out += x @ y.T
    return out.astype(np.int64)


def _comparer(k: int):
    @F.arrow_udf("struct<common:long,either:long>")
    def compare(one: pa.Array, other: pa.Array) -> pa.Array:
        common, either = [], []
        for i in range(len(one)):
            data, offsets = W.text_bytes(pa.concat_arrays([one.slice(i, 1), other.slice(i, 1)]))
            hashes, n = shingle_sets(W.words_of(data, offsets, W.NOT_SPACE), k)
            both = len(np.intersect1d(hashes[: n[0]], hashes[n[0] :], assume_unique=True))
            common.append(both)
            either.append(int(n.sum()) - both)
        return pa.StructArray.from_arrays([pa.array(common, pa.int64()), pa.array(either, pa.int64())], ["common", "either"])

    return compare


def _identity(k: int):
    @F.arrow_udf("long")
    def node(texts: pa.Array) -> pa.Array:
        parts = []
        for _, _, data, offsets in W.chunks(texts):
            hashes, n = shingle_sets(W.words_of(data, offsets, W.NOT_SPACE), k)
            parts.append(node_ids(hashes, n))
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    return node


def _texts(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """``(node, text)`` of the wanted nodes, written."""
    wanted = stored(nodes.select("node", "key").join(wanted.distinct(), "node"), "jaccard-wanted")
    texts = narrowed(docs, wanted, ["key"])
    texts = texts.where(_identity(k)("text") == F.col("node")).select("node", "text")
    return stored(texts.dropDuplicates(["node"]), "jaccard-texts")


def _compared(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """Of pairs of nodes, those ``(a, b)`` that link by their whole sets."""
    pairs = stored(pairs.distinct(), "jaccard-pairs")
    texts = _texts(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), docs, nodes, k)
    first = texts.select(F.col("node").alias("a"), F.col("text").alias("one"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    rows = pairs.join(first, "a").join(second, "b")
    rows = rows.select("a", "b", _comparer(k)("one", "other").alias("r"))
    return stored(rows.where(F.col("r.common") * 100 >= F.col("r.either") * percent).select("a", "b"), "jaccard-links")


def _kept_buckets(rows: DataFrame) -> DataFrame:
    """``rows`` of buckets that hold several nodes, once for buckets with the same ones.

    ``rows`` is dealt by bucket and holds a node of a bucket once.
    """
    buckets = rows.groupBy("token", "cls").agg(
        F.count("*").alias("members"), F.bit_xor(F.xxhash64("node")).alias("which"), F.min("node").alias("least")
    )
    same = ["cls", "members", "which", "least"]
    buckets = buckets.where("members > 1").groupBy(*same).agg(F.min("token").alias("token"))
    return rows.join(buckets.select("token", "cls", "members", "least"), ["token", "cls"])


def _met(asks: DataFrame, members: DataFrame, docs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` of nodes with the components they ask for.

    ``asks(node, root)``; ``members(node, root, size)``.  Both sides are cut into blocks,
    and every block of the one meets every block of the other.
    """
    asks = stored(asks.distinct(), "jaccard-asks")
    asking = asks.groupBy("root").agg(F.ceil(F.count("*") / COMPARED).alias("askers"))
    members = members.join(asking, "root").withColumn("blocks", F.ceil(F.col("size") / COMPARED))
    sizes = members.select("root", "askers", "blocks").distinct()
    count = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    one = asks.join(sizes, "root").select(
        F.col("root").alias("comp"), own("askers").alias("i"), count("blocks").alias("j"), "node", F.lit(True).alias("asks")
    )
    other = members.select(
        F.col("root").alias("comp"), count("askers").alias("i"), own("blocks").alias("j"), "node", F.lit(False).alias("asks")
    )
    rows = stored(one.union(other), "jaccard-meetings")
    rows = rows.join(_texts(rows.select("node"), docs, nodes, k), "node")
    rows = rows.repartition(*_MEETING).sortWithinPartitions(*_MEETING, "node")
    return stored(rows.mapInArrow(_meet(k, percent), "a long, b long"), "jaccard-met")


def _members(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, n, bitmap, root, size)``: the component of each node, and how many nodes it has."""
    roots = components(links)
    sizes = roots.groupBy("root").agg(F.count("*").alias("size"))
    joined = stored(roots.join(sizes, "root"), "jaccard-roots")
    members = nodes.select("node", "n", "bitmap").join(joined, "node", "left").select(
        "node", "n", "bitmap", F.coalesce("root", "node").alias("root"), F.coalesce("size", F.lit(1)).alias("size")
    )
    return stored(members, "jaccard-members")


def _contracted(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Buckets ``(token, cls, node, members, least)`` with components in place of their nodes."""
    changed = members.where("node <> root").select("node", "root")
    kept = F.broadcast(changed) if fits_broadcast(changed) else changed
    rows = rows.join(kept, "node", "left").select("token", "cls", F.coalesce("root", "node").alias("node"))
    return _kept_buckets(rows.repartition("token", "cls").distinct())


def _answered(
    buckets: DataFrame, summed: DataFrame, members: DataFrame, docs: DataFrame, nodes: DataFrame, k: int, percent: int,
    block: int, classes, largest: bool = False,
) -> DataFrame:
    """Links of the nodes of components that may hold one in ``buckets``."""
    rows = buckets.join(_summaries(summed, classes), ["node", "cls"])
    asks = _blocks(rows, block).mapInArrow(_ask(percent, largest), "asker long, root long").distinct()
    own = members.select("node", F.col("root").alias("asker"))
    asks = asks.join(own, "asker").select("node", "root")
    return _met(asks, members.select("node", "root", "size"), docs, nodes, k, percent)


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK,
) -> DataFrame:
    """``(key, n_shingles, component_id)`` per row of ``df``, as the module tells."""
    if percent < 50:
        raise ValueError("sizes that link must lie in neighbouring classes: percent from 50 on")
    small_batches(df.sparkSession)
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    frequent = df.sparkSession.sparkContext.broadcast(_frequent(docs, k))
    sets = stored(docs.mapInArrow(_sets(k, percent, frequent), _SETS), "jaccard-sets")
    nodes = sets.where("n > 0 and key is not null").groupBy("node").agg(
        F.min("key").alias("key"), F.min("n").alias("n"), F.max("bitmap").alias("bitmap")
    )
    nodes = stored(nodes, "jaccard-nodes")
    rows = sets.where("key is not null").select(F.explode("tokens").alias("token"), "node").repartition("token")
    rows = rows.sortWithinPartitions("token", "node").mapInArrow(_shared, "token long, node long")
    # Two sizes that link lie in one class, or the larger is routed to the class below too.
    size = lambda n: F.floor(F.log2(n) + F.lit(1e-12)).cast("int")
    classes = F.array_distinct(F.array(size(F.col("n")), size(F.ceil(F.col("n") * percent / 100))))
    rows = rows.join(nodes.select("node", classes.alias("classes")), "node")
    rows = stored(rows.select("token", F.explode("classes").alias("cls"), "node"), "jaccard-rows")
    lowest = F.row_number().over(Window.partitionBy("node", "cls").orderBy("token"))
    seeds = rows.withColumn("nth", lowest).where(F.col("nth") <= SEEDS).drop("nth")
    seeds = _kept_buckets(stored(seeds, "jaccard-seeds"))
    alone = nodes.select("node", "n", F.col("n").alias("high"), F.lit(-1).cast("long").alias("extra"), "bitmap")
    seeds = seeds.join(alone, "node")
    proposals = _blocks(seeds, block).mapInArrow(_propose(percent), "a long, b long")
    links = _compared(proposals, docs, nodes, k, percent)

    before = None
    while True:
        members = _members(nodes, links)
        open_ = _contracted(rows, members)
        large = stored(open_.where(F.col("members") > OPEN), "jaccard-open")
        now = large.select("node").distinct().count()
        if now == 0 or (before is not None and now > before * STILL):
            break
        before = now
        part = members.join(large.select(F.col("node").alias("root")).distinct(), "root", "left_semi")
        links = links.union(_answered(large, part, members, docs, nodes, k, percent, block, classes, largest=True))
    links = links.union(_answered(open_, members, members, docs, nodes, k, percent, block, classes))
    roots = components(links)

    of = nodes.select("node", "key").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = of.groupBy("root").agg(F.min("key").alias("component"))
    named = of.join(least, "root").select("node", "component")
    out = sets.select("key", "n", "node").join(named, "node", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("key"))
    component = F.when(F.col("key").isNotNull(), component)
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
