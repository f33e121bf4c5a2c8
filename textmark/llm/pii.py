"""Personal data in whole texts: anchors by Aho-Corasick, spans by local parsers.

One pass over a text finds every at-sign, plus sign, digit, scheme and account cue.  From
each anchor a parser expands both ways and validates what it found:

- ``email``: local part before the at-sign, dotted domain after it;
- ``ip``: four dotted numbers of at most 255;
- ``card``: 16 to 19 digits, single blanks or hyphens between them, Luhn sum right;
- ``phone``: plus sign, 8 to 15 digits with blanks, brackets, dots and hyphens;
- ``account``: after a cue word, an IBAN whose check digits hold or 8 to 17 digits;
- ``url``: an address that names a user before its host, or whose host is a number.

The first four are leftmost, longest and do not overlap within a kind; what fails its
validation is dropped without another try.

Defined results: a null text has no spans and stays null when redacted; an empty text has
none; equal texts give equal spans; positions are code points, ends exclusive.
"""

from __future__ import annotations

import bisect

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone", "account", "url")
BASE = KINDS[:4]
SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]
    )
)
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])

_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_URL_END = frozenset(" \t\r\n\x0b\x0c<>\"'`|")
_CUES = ("iban", "account", "acct", "konto", "kontonummer", "cuenta", "compte")
_SCHEMES = ("http://", "https://", "ftp://")

Span = tuple[int, int]


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in _DIGITS:
        found.add_word(digit, "d")
    found.add_word("@", "@")
    found.add_word("+", "+")
    for cue in _CUES:
        for form in (cue, cue.upper(), cue.title()):
            found.add_word(form, "cue")
    for scheme in _SCHEMES:
        for form in (scheme, scheme.upper()):
            found.add_word(form, scheme)
    found.make_automaton()
    return found


def emails(text: str, anchors: list[int]) -> list[Span]:
    out, free = [], 0
    for at in anchors:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        stop = _domain(text, at + 1)
        if start < at and stop:
            out.append((start, stop))
            free = stop
    return out


def _domain(text: str, at: int) -> int:
    """End of two or more dotted labels from ``at`` on, or 0."""
    n, stop, labels = len(text), 0, 0
    while True:
        end = at
        while end < n and text[end] in _LABEL:
            end += 1
        if end == at:
            break
        labels, stop = labels + 1, end
        if end >= n or text[end] != ".":
            break
        at = end + 1
    return stop if labels > 1 else 0


def digit_runs(positions: list[int]) -> list[Span]:
    if not positions:
        return []
    p = np.array(positions)
    new = np.flatnonzero(np.append(True, p[1:] != p[:-1] + 1))
    return list(zip(p[new].tolist(), (p[np.append(new[1:] - 1, len(p) - 1)] + 1).tolist(), strict=True))


def addresses(text: str, runs: list[Span]) -> list[Span]:
    out, i = [], 0
    while i + 3 < len(runs):
        four = runs[i : i + 4]
        if all(b[0] == a[1] + 1 and text[a[1]] == "." for a, b in zip(four, four[1:], strict=False)):
            if all(_small(text, run) for run in four):
                out.append((four[0][0], four[3][1]))
            i += 4
        else:
            i += 1
    return out


def _small(text: str, run: Span) -> bool:
    digits = text[run[0] : run[1]].lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def cards(text: str, runs: list[Span]) -> list[Span]:
    out, i = [], 0
    while i < len(runs):
        j = i
        while j + 1 < len(runs) and runs[j + 1][0] == runs[j][1] + 1 and text[runs[j][1]] in " -":
            j += 1
        count = sum(b - a for a, b in runs[i : j + 1])
        if 16 <= count <= 19 and luhn("".join(text[a:b] for a, b in runs[i : j + 1])):
            out.append((runs[i][0], runs[j][1]))
        i = j + 1
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if i % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def phones(text: str, anchors: list[int]) -> list[Span]:
    out, n = [], len(text)
    for at in anchors:
        if at + 1 >= n or text[at + 1] not in _DIGITS:
            continue
        end = at + 2
        while end < n and text[end] in _PHONE:
            end += 1
        while end > at + 3 and text[end - 1] not in _DIGITS:
            end -= 1
        if end <= at + 3:
            continue
        if 8 <= sum(c in _DIGITS for c in text[at:end]) <= 15:
            out.append((at, end))
    return out


def accounts(text: str, anchors: list[int]) -> list[Span]:
    """Behind each cue: an IBAN, or a plain number; a few signs or one short word between."""
    out, n, free = [], len(text), 0
    for at in anchors:
        start, skipped = at, 0
        while start < n and skipped < 12 and not text[start].isdigit():
            if text[start].isalpha() and (stop := _iban(text, start)):
                if start >= free:
                    out.append((start, stop))
                    free = stop
                break
            start, skipped = start + 1, skipped + 1
        else:
            stop = start
            while stop < n and text[stop] in _DIGITS:
                stop += 1
            if 8 <= stop - start <= 17 and start >= free and (stop == n or text[stop] not in _ALNUM):
                out.append((start, stop))
                free = stop
    return out


def _iban(text: str, start: int) -> int:
    if start and text[start - 1] in _ALNUM:
        return 0
    chars, at = [], start
    while at < len(text) and len(chars) < 34:
        if text[at] in _ALNUM:
            chars.append(text[at].upper())
        elif text[at] != " ":
            break
        at += 1
        country = "".join(chars[:4])
        if len(chars) >= 2 and not country[:2].isalpha() or len(chars) >= 4 and not country[2:].isdigit():
            return 0
        ends = at == len(text) or text[at] not in _ALNUM
        if len(chars) >= 15 and ends and text[at - 1] != " ":
            moved = "".join(chars[4:] + chars[:4])
            if int("".join(str(int(c, 36)) for c in moved)) % 97 == 1:
                return at
    return 0


def urls(text: str, anchors: list[tuple[int, str]], ats: list[int]) -> list[Span]:
    """Addresses behind schemes that name a user or a numeric host; ``ats`` are the at-signs.

    Ends of runs and hosts are found once for all schemes inside them, so a text that
    repeats a scheme costs its length.
    """
    out, n, free, blank, mark = [], len(text), 0, 0, 0
    for at, scheme in anchors:
        start = at - len(scheme)
        if start < free or start and text[start - 1] in _ALNUM:
            continue
        if at > blank or blank == 0:
            blank = at
            while blank < n and text[blank] not in _URL_END:
                blank += 1
        if at > mark or mark == 0:
            mark = at
            while mark < blank and text[mark] not in "/?#":
                mark += 1
        stop, host = blank, min(mark, blank)
        nth = bisect.bisect_left(ats, at)
        named = nth < len(ats) and ats[nth] < host and text[at] != "@"
        if named or _numeric_host(text, at, host):
            while stop > host and text[stop - 1] in ".,;:!?)":
                stop -= 1
            out.append((start, stop))
            free = stop
    return out


def _numeric_host(text: str, at: int, host: int) -> bool:
    """Whether four small numbers joined by dots stand at ``at``."""
    for part in range(4):
        first = at
        while at < host and text[at] in _DIGITS:
            at += 1
        if first == at or not _small(text, (first, at)):
            return False
        if part < 3:
            if at == host or text[at] != ".":
                return False
            at += 1
    return True


def spans_of(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Spans of a text by kind in the order of ``KINDS``, then by start."""
    at: dict[str, list] = {"d": [], "@": [], "+": [], "cue": [], "url": []}
    for end, what in automaton.iter(text):
        if what in at:
            at[what].append(end + (what == "cue"))
        else:
            at["url"].append((end + 1, what))
    runs = digit_runs(at["d"])
    found = (
        emails(text, at["@"]), addresses(text, runs), cards(text, runs),
        phones(text, at["+"]), accounts(text, at["cue"]), urls(text, at["url"], at["@"]),
    )
    return [(kind, a, b) for kind, spans in zip(KINDS, found, strict=True) for a, b in spans]


@F.arrow_udf(SPANS)
def _find(texts: pa.Array) -> pa.Array:
    automaton = _shared()
    kinds, starts, stops, counts = [], [], [], []
    for text in texts:
        found = spans_of(text.as_py() or "", automaton)
        counts.append(len(found))
        for kind, start, stop in found:
            kinds.append(kind)
            starts.append(start)
            stops.append(stop)
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    values = pa.StructArray.from_arrays(
        [pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())], fields=list(_SPAN)
    )
    return pa.ListArray.from_arrays(pa.array(offsets), values)


_kept: list[ahocorasick.Automaton] = []


def _shared() -> ahocorasick.Automaton:
    if not _kept:
        _kept.append(_automaton())
    return _kept[0]


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping ones the first names it."""
    out, at = [], 0
    for start, stop, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, stop)
    return "".join([*out, text[at:]])


@F.arrow_udf(T.StringType())
def _redact(texts: pa.Array) -> pa.Array:
    automaton, out = _shared(), []
    for text in texts:
        text = text.as_py()
        spans = spans_of(text, automaton) if text else []
        out.append(redacted(text, spans) if spans else text)
    return pa.array(out, pa.string())


def find(text: Column) -> Column:
    """Spans of personal data, as ``SPANS``."""
    return _find(text)


def redact(text: Column) -> Column:
    """The text with every span replaced by ``<kind>``."""
    return _redact(text)


def joined(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the given kinds, comma-joined."""
    chosen = F.filter(spans, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
