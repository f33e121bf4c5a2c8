"""SentencePiece ids of whole texts, each with the bytes of the original that it covers.

1. *Normalisation.*  The compiled character map of the model is a double-array trie of byte
   strings and what replaces them.  At every character the longest key that begins there is
   looked up, for all characters of a chunk of texts at once; the match is replaced, any
   other character stays.  Each byte that comes out records where its source began.  White
   space is then collapsed, escaped and prefixed as the model's settings say.
2. *Segmentation.*  The normalised text goes through the model's merges with its own
   normaliser switched off, so what is segmented is what was aligned.  Where no piece holds
   an escaped blank behind another character, no merge crosses such a place, and long texts
   are cut there.
3. *Projection.*  A piece covers the source bytes of its normalised bytes.  Of pieces that
   share one source (bytes of a character, parts of a replacement) the last covers it.

Defined results: a null text is empty; an empty text has the begin and end ids only; bytes
that are not UTF-8 count as one U+FFFD each; a null key stays; equal rows get equal rows;
other columns are not read unless named in ``keep``.  Memory follows a chunk of texts, or a
single longer one.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmark.llm import words as W

#: Normalised characters from which on a text is segmented in parts.
LONG = 1 << 18
#: Ids that are decoded at a time.
DECODED = 1 << 19
_BLANK = "▁"
_ESCAPED = np.frombuffer(_BLANK.encode(), np.uint8)
_REPLACEMENT = np.frombuffer("�".encode(), np.uint8)
# Kinds of pieces and numbers of fields in the public model format: fixed values.
_UNKNOWN, _USER_DEFINED, _BYTE = 2, 4, 6
_PIECES, _TRAINER, _NORMALISER = 1, 2, 3
_CHARACTER_MAP, _DUMMY_PREFIX, _REMOVE_EXTRA, _ESCAPE = 2, 3, 4, 5
_BLANK_AS_SUFFIX = 24
#: Appended to a model: an empty character map, no prefix, no collapsing, no escapes.
_IDENTITY = bytes([0x1A, 8, 0x12, 0, 0x18, 0, 0x20, 0, 0x28, 0])


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """``(number, value)`` of a protobuf message; numbers as int, the rest as bytes."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
            yield tag >> 3, value
            continue
        if tag & 7 == 2:
            size, at = number(at)
        else:
            size = 8 if tag & 7 == 1 else 4
        yield tag >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """The trie of a compiled character map; ``longest`` looks up many places at once."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], np.uint32)
        self.texts = np.frombuffer(blob[4 + size :], np.uint8)
        stops = np.flatnonzero(self.texts == 0)
        self.stop = lambda at: stops[np.searchsorted(stops, at)]

    def longest(self, data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length of the longest key at each place (0: none) and where its replacement begins.

        ``end`` is where the text of a place ends.
        """
        length, value = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        if len(self.units) == 0:
            return length, value
        offset = lambda u: (u >> np.uint32(10)) << ((u & np.uint32(512)) >> np.uint32(6))
        alive = np.arange(len(at))
        node = np.full(len(at), offset(self.units[:1])[0], np.uint32)
        for step in itertools.count():
            keep = at[alive] + step < end[alive]
            alive, node = alive[keep], node[keep]
            if len(alive) == 0:
                return length, value
            byte = data[at[alive] + step].astype(np.uint32)
            node = node ^ byte
            inside = node < len(self.units)
            unit = self.units[np.where(inside, node, 0)]
            keep = inside & (unit & np.uint32(0x800000FF) == byte)
            alive, node, unit = alive[keep], node[keep], unit[keep]
            node = node ^ offset(unit)
            leaf = (unit >> np.uint32(8)) & np.uint32(1) == 1
            length[alive[leaf]] = step + 1
            value[alive[leaf]] = self.units[node[leaf]] & np.uint32(0x7FFFFFFF)


class Normalised:
    """Normalised texts, and for each of their bytes where its source begins in its text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, source: np.ndarray, ends: np.ndarray):
        self.data, self.offsets, self.source, self.ends = data, offsets, source, ends

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode()


class Model:
    """A model file: its character map and settings, and its segmentation alone."""

    def __init__(self, data: bytes):
        kinds, lengths, inner = [], [], False
        self.prefix = self.collapse = self.escape = True
        suffix, blob = 0, b""
        for number, value in _fields(data):
            if number == _PIECES:
                piece = dict(_fields(value))
                kind, text = piece.get(3, 1), piece.get(1, b"")
                kinds.append(kind)
                lengths.append(1 if kind == _BYTE else len(text))
                inner |= _BLANK in text.decode(errors="replace").lstrip(_BLANK)
            elif number == _TRAINER:
                suffix = dict(_fields(value)).get(_BLANK_AS_SUFFIX, 0)
            elif number == _NORMALISER:
                rules = dict(_fields(value))
                blob = rules.get(_CHARACTER_MAP, b"")
                self.prefix = bool(rules.get(_DUMMY_PREFIX, 1))
                self.collapse = bool(rules.get(_REMOVE_EXTRA, 1))
                self.escape = bool(rules.get(_ESCAPE, 1))
        if suffix or _USER_DEFINED in kinds:
            raise ValueError("models with blanks as suffix or user-defined pieces are not supported")
        self.map = CharacterMap(blob)
        self.lengths = np.array(lengths, np.int64)
        self.unknown = np.array(kinds) == _UNKNOWN
        self.cut = self.escape and not inner
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=data + _IDENTITY)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=data)

    def normalise(self, data: np.ndarray, offsets: np.ndarray) -> Normalised:
        """Texts ``data[offsets[i]:offsets[i+1]]``, valid UTF-8."""
        texts = len(offsets) - 1
        start = np.flatnonzero((data & 0xC0) != 0x80)
        text = np.searchsorted(offsets, start, side="right") - 1
        size = np.diff(np.append(start, len(data)))
        length, value = self.map.longest(data, start, offsets[1:][text])
        wide = np.flatnonzero(length > size)
        if len(wide):  # such a match swallows the characters behind its first
            free, gone = 0, np.zeros(len(start), bool)
            for i in wide.tolist():
                if start[i] >= free:
                    free = start[i] + length[i]
                    gone[i + 1 : np.searchsorted(start, free)] = True
            start, text, size, length, value = (x[~gone] for x in (start, text, size, length, value))
        matched = length > 0
        out = size.copy()
        if matched.any():
            out[matched] = self.map.stop(value[matched]) - value[matched]
        source = np.repeat(start, out)
        owner = np.repeat(text, out)
        step = np.arange(len(source)) - np.repeat(np.cumsum(out) - out, out)
        from_map = np.repeat(matched, out)
        spelled = np.empty(len(source), np.uint8)
        spelled[~from_map] = data[(source + step)[~from_map]]
        if from_map.any():
            spelled[from_map] = self.map.texts[(np.repeat(value, out) + step)[from_map]]
        stop = offsets[1:].copy()  # where the source of each text ends
        blank = spelled == 0x20
        if self.collapse and len(spelled):
            new = np.append(True, owner[1:] != owner[:-1])  # first byte of its text
            keep = ~blank | ~(new | np.append(True, blank[:-1]))
            spelled, source, owner, blank = (x[keep] for x in (spelled, source, owner, blank))
            keep = self._without_tails(spelled, source, owner, stop)
            spelled, source, owner, blank = (x[keep] for x in (spelled, source, owner, blank))
        first = np.searchsorted(owner, np.arange(texts))
        held = np.bincount(owner, minlength=texts) > 0
        if self.prefix and len(spelled):
            at = first[held]
            spelled, blank = np.insert(spelled, at, 0x20), np.insert(blank, at, True)
            source, owner = np.insert(source, at, source[at]), np.insert(owner, at, owner[at])
        if self.escape and len(spelled):
            width = np.where(blank, len(_ESCAPED), 1)
            at = np.flatnonzero(blank)
            places = (np.cumsum(width) - width)[at][:, None] + np.arange(len(_ESCAPED))
            spelled, source, owner = (np.repeat(x, width) for x in (spelled, source, owner))
            spelled[places] = _ESCAPED
        bounds = np.searchsorted(owner, np.arange(texts + 1))
        return Normalised(spelled, bounds, source - offsets[owner], stop - offsets[:-1])

    def _without_tails(self, spelled: np.ndarray, source: np.ndarray, owner: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Which bytes stay when blanks, escaped ones too, end no text; ``stop`` follows."""
        keep = np.ones(len(spelled), bool)
        last = np.flatnonzero(np.append(owner[1:] != owner[:-1], True)) if len(owner) else owner
        first = np.searchsorted(owner, owner[last])
        suspect = (spelled[last] == 0x20) | (self.escape & (spelled[last] == _ESCAPED[-1]))
        for low, high in zip(first[suspect].tolist(), (last[suspect] + 1).tolist(), strict=True):
            end = high
            while end > low:
                if spelled[end - 1] == 0x20:
                    end -= 1
                elif self.escape and end - low >= 3 and (spelled[end - 3 : end] == _ESCAPED).all():
                    end -= 3
                else:
                    break
            if end < high:
                keep[end:high] = False
                stop[owner[low]] = source[end]
        return keep

    def _parts(self, text: str) -> list[str]:
        """A long text cut before blanks that follow another character."""
        if len(text) <= LONG or not self.cut:
            return [text]
        parts, at = [], 0
        while len(text) - at > LONG:
            to = at + LONG
            while True:
                to = text.find(_BLANK, to)
                if to < 0 or text[to - 1] != _BLANK:
                    break
                to += 1
            if to < 0:
                break
            parts.append(text[at:to])
            at = to
        return [*parts, text[at:]]

    def pieces(self, normal: Normalised) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, where each ends in the normalised bytes, and how many per text."""
        texts = [normal.text(i) for i in range(len(normal.offsets) - 1)]
        parts = [self._parts(text) for text in texts]
        ids = self.plain.encode(list(itertools.chain.from_iterable(parts)), num_threads=1)
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in parts])
        counts = np.bincount(owner, [len(x) for x in ids], len(texts)).astype(np.int64)
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(counts.sum()))
        length = self.lengths[flat]
        if self.unknown[flat].any():  # an unknown piece is as long as what it stands for
            spelled = itertools.chain.from_iterable(
                self.plain.encode(part, out_type=str) for part in itertools.chain.from_iterable(parts)
            )
            spelled = np.fromiter((len(x.encode()) for x in spelled), np.int64, len(flat))
            length = np.where(self.unknown[flat], spelled, length)
        return flat, np.cumsum(length), counts


@functools.lru_cache(maxsize=2)
def load(path: str) -> Model:
    with open(path, "rb") as file:
        return Model(file.read())


def _valid(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Valid UTF-8, its offsets, and where each byte stood (None: where it stands)."""
    try:
        data.tobytes().decode()
        cut = offsets[1:-1][offsets[1:-1] < len(data)]
        if not ((data[cut] & 0xC0) == 0x80).any():
            return data, offsets, None
    except UnicodeDecodeError:
        pass
    parts, places, bounds = [], [], [0]
    for start, stop in itertools.pairwise(offsets.tolist()):
        size, at = bounds[-1], start
        while at < stop:
            raw = data[at:stop].tobytes()
            try:
                raw.decode()
                good, bad = len(raw), False
            except UnicodeDecodeError as error:
                good, bad = error.start, True
            parts.append(data[at : at + good])
            places.append(np.arange(at, at + good))
            if bad:
                parts.append(_REPLACEMENT)
                places.append(np.full(len(_REPLACEMENT), at + good))
            size += good + len(_REPLACEMENT) * bad
            at += good + bad
        bounds.append(size)
    none = np.zeros(0, np.int64)
    return np.concatenate([*parts, none.astype(np.uint8)]), np.array(bounds), np.concatenate([*places, none])


def encode(model: Model, data: np.ndarray, offsets: np.ndarray, begin: bool, end: bool):
    """``(ids, begins, ends, counts)`` of texts, spans in bytes of each original text."""
    valid, bounds, place = _valid(data, offsets)
    normal = model.normalise(valid, bounds)
    ids, stop, counts = model.pieces(normal)
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.append(0, stop[:-1]) if len(stop) else stop
    begins = normal.source[start]
    last = stop == normal.offsets[1:][text]
    ends = np.where(last, normal.ends[text], normal.source[np.where(last, start, stop)])
    if place is not None:
        place = np.append(place, len(data))
        own, base = bounds[text], offsets[text]
        begins, ends = place[begins + own] - base, np.where(
            ends + own == bounds[text + 1], offsets[text + 1], place[ends + own]
        ) - base
    size = np.diff(offsets)
    first = np.cumsum(counts) - counts
    if end:
        at = first + counts
        ids, begins, ends = np.insert(ids, at, model.whole.eos_id()), np.insert(begins, at, size), np.insert(ends, at, size)
        counts = counts + 1
        first = np.cumsum(counts) - counts
    if begin:
        ids, begins, ends = np.insert(ids, first, model.whole.bos_id()), np.insert(begins, first, 0), np.insert(ends, first, 0)
        counts = counts + 1
    return ids, begins, ends, counts


def _binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Little-endian 32-bit numbers of each row as one binary."""
    offsets = np.append(0, np.cumsum(counts)).astype(np.int64) * 4
    data = values.astype("<u4").tobytes()
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    ).cast(pa.binary())


_ENCODED = [
    T.StructField("n_tokens", T.LongType()),
    *[T.StructField(x, T.BinaryType()) for x in ("ids", "begins", "ends")],
]



def encoded(
    df: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), text: str = "text", begin: bool = True, end: bool = True
) -> DataFrame:
    """Columns ``keep``, the number of ids, and ids, begins and ends packed in 32 bits each.

    ``path`` names the model file on every machine; ``numbers`` unpacks the binaries.
    """
    keep = list(keep)
    rows = df.select(*[F.col(x).alias(f"k{i}") for i, x in enumerate(keep)], F.col(text).alias("t"))
    kept = [T.StructField(f"k{i}", df.schema[x].dataType) for i, x in enumerate(keep)]
    schema = T.StructType([*kept, *_ENCODED])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for start, stop, data, offsets in W.chunks(batch.column("t")):
                ids, begins, ends, counts = encode(model, data, offsets, begin, end)
                columns = [batch.column(i).slice(start, stop - start) for i in range(len(keep))]
                columns.append(pa.array(counts, pa.int64()))
                columns += [_binaries(x, counts) for x in (ids, begins, ends)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(x) for i, x in enumerate(keep)], "n_tokens", "ids", "begins", "ends")


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def numbers(packed: pa.Array) -> pa.Array:
    """Packed 32-bit numbers as an array."""
    rows = [None if x is None else np.frombuffer(x, "<i4") for x in packed.to_pylist()]
    return pa.array(rows, pa.list_(pa.int32()))


def decoded(df: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """Columns ``keep`` and ``text``, what the packed ids spell; begin and end ids spell nothing."""
    keep = list(keep)
    rows = df.select(*[F.col(x).alias(f"k{i}") for i, x in enumerate(keep)], F.col(ids).alias("ids"))
    kept = [T.StructField(f"k{i}", df.schema[x].dataType) for i, x in enumerate(keep)]
    schema = T.StructType([*kept, T.StructField("text", T.StringType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            packed = batch.column("ids").fill_null(b"")
            total = np.cumsum([len(x.as_buffer()) // 4 for x in packed])
            at = 0
            while at < len(packed):
                stop = int(np.searchsorted(total, (total[at - 1] if at else 0) + DECODED, side="right"))
                stop = min(max(stop, at + 1), len(packed))
                some = [np.frombuffer(x.as_buffer(), "<i4").tolist() for x in packed.slice(at, stop - at)]
                columns = [batch.column(i).slice(at, stop - at) for i in range(len(keep))]
                columns.append(pa.array(model.whole.decode(some, num_threads=1), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at = stop

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(x) for i, x in enumerate(keep)], "text")
