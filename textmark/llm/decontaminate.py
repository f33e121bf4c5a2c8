"""Benchmark passages in training texts, found by winnowing.

A window is ``window`` consecutive words of a benchmark item.  Every text keeps, out of
each ``window - k + 1`` consecutive hashes of k words, the smallest.  A text and an item
that share a window share that choice, so every shared window is reached from a shared
fingerprint; the windows around each shared fingerprint are then compared.  An item
shorter than a window is one window of its own length, looked up at every position.

Texts are never shuffled.  The benchmark is the stated query set: it is taken in blocks
of bounded size, each sent to the tasks that read the texts.

Defined results: null or wordless texts have no words and no hits; items without words
have no window; an item whose id is null marks words but is not listed; equal item ids
are listed once; equal texts get equal rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmark.llm import words as W

WINDOW = 13
GRAM = 8
#: Words of the benchmark that are sent to the tasks at once.
BLOCK_WORDS = 1_000_000
#: Bytes of text whose words are held while several blocks pass.
HELD_BYTES = 16 << 20

RESULT = "struct<n_words:long,n_hit:long,spans:array<struct<start:long,stop:long>>,items:array<string>>"
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])


def winnowed(words: W.Words, k: int, take: int) -> np.ndarray:
    """Positions whose hash of k words is smallest among ``take`` consecutive ones."""
    hashes = W.grams(words.hashes, k)
    n = len(hashes)
    if n < take:
        return W.whole_grams(words, k)
    whole = words.text[:n] == words.text[k - 1 : k - 1 + n]
    hashes[~whole] = np.uint64(0xFFFFFFFFFFFFFFFF)  # never smaller than one within a text
    least = hashes[: n - take + 1].copy()
    for j in range(1, take):
        np.minimum(least, hashes[j : n - take + 1 + j], out=least)
    # A hash is kept if some run of ``take`` that holds it has it as its smallest.
    most = np.zeros(n, np.uint64)
    for j in range(take):
        np.maximum(most[j : n - take + 1 + j], least, out=most[j : n - take + 1 + j])
    return np.flatnonzero((hashes == most) & whole)


class Index:
    """Windows and fingerprints of a block of items."""

    def __init__(self, items: pa.Table, window: int = WINDOW, k: int = GRAM):
        self.window, self.k = window, k
        data, offsets = W.text_bytes(items["text"])
        words = W.words_of(data, offsets, W.ALNUM)
        self.ids = [None if x is None else str(x) for x in items["item_id"].to_pylist()]
        n = words.counts
        prints = winnowed(words, k, window - k + 1)
        prints = prints[n[words.text[prints]] >= window] if len(prints) else prints
        self.prints = np.unique(W.grams(words.hashes, k)[prints]) if len(prints) else np.zeros(0, np.uint64)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in sorted({min(int(x), window) for x in n if x}):
            at = W.whole_grams(words, length)
            of = words.text[at]
            at = at[(n[of] == length) | ((length == window) & (n[of] > window))]
            pairs = np.unique(
                np.rec.fromarrays([W.grams(words.hashes, length)[at], words.text[at]], names="h,i")
            )
            hashes, first = np.unique(pairs.h, return_index=True)
            self.tables[length] = (hashes, np.append(first, len(pairs)), pairs.i)

    def hits(self, words: W.Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each window length: where windows begin, and which window it is."""
        for length, (hashes, _, _) in self.tables.items():
            if length == self.window:
                at = winnowed(words, self.k, self.window - self.k + 1)
                at = at[_find(self.prints, W.grams(words.hashes, self.k)[at])[0]] if len(at) else at
                spread = self.window - self.k
                at = np.unique((at[:, None] - np.arange(spread + 1)).ravel())
                at = at[(at >= 0) & (at + length <= len(words.hashes))]
                at = at[words.text[at] == words.text[at + length - 1]] if len(at) else at
            else:
                at = W.whole_grams(words, length)
            if len(at):
                found, which = _find(hashes, _grams_at(words.hashes, at, length))
                yield length, at[found], which[found]


def _grams_at(hashes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    if len(at) * 4 > len(hashes):
        return W.grams(hashes, k)[at]
    runs = hashes[(at[:, None] + np.arange(k)).ravel()]
    return W.grams(runs, k)[::k]


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(table) == 0:
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return table[at] == wanted, at


_EMPTY = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))]
)


def mark(blocks: Callable[[], Iterator[Index]], texts: pa.Array, together: int = 1) -> pa.Array:
    """Results for a batch of texts; ``blocks`` gives the indexes one after another.

    Words are held for about ``together`` bytes of text at a time, for which all blocks are
    gone through once.
    """
    out, held, size = [], [], 0
    for start, stop, data, offsets in W.chunks(texts):
        held.append((stop - start, data, offsets))
        size += len(data)
        if size >= together:
            out += _marked(blocks, held)
            held, size = [], 0
    out += _marked(blocks, held)
    return pa.concat_arrays(out) if out else pa.array([], _EMPTY)


def _marked(blocks: Callable[[], Iterator[Index]], chunks: list[tuple]) -> list[pa.Array]:
    runs = []
    for rows, data, offsets in chunks:
        words = W.words_of(data, offsets, W.ALNUM)
        runs.append((rows, words, np.zeros(len(words.hashes) + 1, np.int32), [set() for _ in range(rows)]))
    for index in blocks() if runs else ():
        for _, words, change, items in runs:
            for length, at, which in index.hits(words):
                np.add.at(change, at, 1)
                np.add.at(change, at + length, -1)
                _, begins, owners = index.tables[length]
                for text, window in set(zip(words.text[at].tolist(), which.tolist(), strict=True)):
                    found = owners[begins[window] : begins[window + 1]]
                    items[text].update(index.ids[i] for i in found if index.ids[i] is not None)
    return [_results(*run) for run in runs]


def _results(rows: int, words: W.Words, change: np.ndarray, items: list[set[str]]) -> pa.Array:
    total, first = len(words.hashes), words.first
    hit = np.cumsum(change[:-1]) > 0
    edge = np.ones(total, bool)
    if total:
        edge[1:] = (hit[1:] != hit[:-1]) | (words.text[1:] != words.text[:-1])
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], total)
    begin, end = begin[hit[begin]], end[hit[begin]]
    owner = words.text[begin]
    spans = pa.StructArray.from_arrays(
        [pa.array(begin - first[owner], pa.int64()), pa.array(end - first[owner], pa.int64())], fields=list(_SPAN)
    )
    return pa.StructArray.from_arrays(
        [
            pa.array(words.counts, pa.int64()),
            pa.array(np.bincount(words.text[hit], minlength=rows), pa.int64()),
            W.list_array(spans, np.bincount(owner, minlength=rows)),
            pa.array([sorted(x) for x in items], pa.list_(pa.string())),
        ],
        names=["n_words", "n_hit", "spans", "items"],
    )


def contamination(
    benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW,
    k: int = GRAM, block_words: int = BLOCK_WORDS,
) -> Callable[[Column], Column]:
    """A function from a text column to ``RESULT``: hit words, their spans, and the items.

    Reads the benchmark once to size the blocks and once per block.  Tasks hold one block
    at a time, however large the benchmark is.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (block_words * 4)))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    shared = [
        spark.sparkContext.broadcast(Index(items.where(part == number).toArrow(), window, k))
        for number in range(blocks)
    ]

    def one_by_one() -> Iterator[Index]:
        for block in shared:
            yield block.value
            if len(shared) > 1:  # read again from the local copy for the next batch
                block.__dict__.pop("_value", None)

    @F.arrow_udf(RESULT)
    def result(texts: pa.Array) -> pa.Array:
        return mark(one_by_one, texts, 1 if len(shared) == 1 else HELD_BYTES)

    return result


def contaminated(result: Column) -> Column:
    """A text counts as contaminated from one hit word in twenty on."""
    return (result["n_hit"] > 0) & (result["n_hit"] * 20 >= result["n_words"])
