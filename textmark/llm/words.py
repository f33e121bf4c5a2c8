"""Words of many texts at once, as 64-bit hashes in numpy arrays.

Texts stay UTF-8 bytes: every separator used here is ASCII, so no character is ever
cut.  A chunk of texts is hashed with one prefix sum, whatever the lengths of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 512 << 10

_BYTES = np.arange(256)
#: Bytes of words that white space ends: everything but 0x20 and 0x09-0x0D.
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Bytes of words made of letters, digits and everything beyond ASCII.
ALNUM = (
    ((_BYTES >= 0x30) & (_BYTES <= 0x39))
    | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
    | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
    | (_BYTES >= 0x80)
)

_BASE = 0x9E3779B97F4A7C15
_GRAM = np.uint64(0xD6E8FEB86659FD93)
#: One random number per byte; capitals A-Z share the number of their small letter.
_OF_BYTE = np.random.default_rng(20240607).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_OF_BYTE[0x41:0x5B] = _OF_BYTE[0x61:0x7B]

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _powers_to(n: int) -> None:
    global _powers, _inverse
    if len(_powers) < n:
        n = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 2))
        step = np.full(n, _BASE, np.uint64)
        step[0] = 1
        _powers = np.cumprod(step)
        step[1:] = np.uint64(pow(_BASE, -1, 1 << 64))
        _inverse = np.cumprod(step)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of consecutive texts: hash and text of each, and how many per text."""

    hashes: np.ndarray
    text: np.ndarray
    counts: np.ndarray
    starts: np.ndarray  # byte positions in the chunk
    ends: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Index of the first word of each text."""
        return np.cumsum(self.counts) - self.counts


def words_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """``data[offsets[i]:offsets[i+1]]`` is text i; ``inside`` marks bytes of words."""
    texts = len(offsets) - 1
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, np.zeros(texts, np.int64), none, none)
    is_word = inside[data]
    edge = np.empty(n, bool)  # not joined to the byte before
    edge[0] = True
    np.not_equal(is_word[1:], is_word[:-1], out=edge[1:])
    cuts = offsets[:-1][offsets[:-1] < n]
    edge[cuts] = True
    runs = np.flatnonzero(edge)
    ends = np.append(runs[1:], n)
    keep = is_word[runs]
    starts, ends = runs[keep], ends[keep]
    _powers_to(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_OF_BYTE[data] * _powers[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * _inverse[starts])
    text = np.searchsorted(offsets, starts, side="right") - 1
    return Words(hashes, text, np.bincount(text, minlength=texts), starts, ends)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; wraps into nothing at the end."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[k - 1 : k - 1 + n].copy()
    for j in range(k - 2, -1, -1):
        out *= _GRAM
        out += hashes[j : j + n]
    return mix(out + np.uint64(k))


def whole_grams(words: Words, k: int) -> np.ndarray:
    """Positions at which k words of the same text begin."""
    n = len(words.hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.text[:n] == words.text[k - 1 : k - 1 + n])


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; a null is an empty text."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_string()).fill_null("")
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, values = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(array: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: (first row, end row, bytes, offsets).

    A longer text is a run of its own, so memory follows the longest text.
    """
    data, offsets = text_bytes(array)
    rows, at = len(offsets) - 1, 0
    while at < rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), rows)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def list_array(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """One list per row, ``counts[i]`` values each."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
