import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from textmark.llm import words as W

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ09 \t\n.,ąÉ \U0001f600-", max_size=40)), max_size=12)


def plain(text, pattern):
    return pattern.findall((text or "").translate(LOWER))


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_and_grams_are_those_of_the_patterns(texts, limit):
    for inside, pattern in ((W.NOT_SPACE, SPACED), (W.ALNUM, ALNUM)):
        expected = [plain(t, pattern) for t in texts]
        names, seen = {}, {}
        row = 0
        for start, stop, data, offsets in W.chunks(pa.array(texts, pa.string()), limit):
            assert start == row
            row = stop
            words = W.words_of(data, offsets, inside)
            assert words.counts.tolist() == [len(x) for x in expected[start:stop]]
            flat = [w for x in expected[start:stop] for w in x]
            for word, value in zip(flat, words.hashes.tolist(), strict=True):
                assert names.setdefault(word, value) == value
                assert seen.setdefault(value, word) == word
            found = W.grams(words.hashes, 2)[W.whole_grams(words, 2)] if len(flat) > 1 else []
            assert len(found) == sum(max(len(x) - 1, 0) for x in expected[start:stop])
        assert row == len(texts)


def test_slices_and_empty_arrays():
    data, offsets = W.text_bytes(pa.array(["ab", None, "cd"]).slice(1, 2))
    assert data.tobytes() == b"cd" and offsets.tolist() == [0, 0, 2]
    assert list(W.chunks(pa.array([], pa.string()))) == []
    none = W.words_of(np.zeros(0, np.uint8), np.zeros(3, np.int64), W.ALNUM)
    assert none.counts.tolist() == [0, 0]
