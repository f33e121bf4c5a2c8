"""SentencePiece ids, spans and texts beside the library's own."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from textmark.llm import queries, spiece
from textmark.llm import words as W

PATH = public_tokenizers.path("piece_bpe_32k.model")
POOL = "aeiouAǺ̈ﬁ①　  ​ガﾊﾟ㍿½x ȩ각각 😀\n▁<s>\x00"
ODD = ["", " ", "   ", "  a  b ", "a\x00b", "▁x ▁", "żółć 😀 𝔘 ́", "é" * 3, "　　", "ｆｕｌｌ　ｗｉｄｔｈ ﬁ ㍿"]


def odd_texts(seed, n=400):
    rng = random.Random(seed)
    return ODD + ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def encoded(model, texts, begin=False, end=False):
    data, offsets = W.text_bytes(pa.array(texts, pa.string()))
    ids, begins, ends, counts = spiece.encode(model, data, offsets, begin, end)
    cuts = np.append(0, np.cumsum(counts))
    return [(ids[a:b].tolist(), list(zip(begins[a:b].tolist(), ends[a:b].tolist(), strict=True))) for a, b in itertools.pairwise(cuts)]


def test_ids_and_spans_are_the_library_s():
    model = spiece.load(PATH)
    texts = odd_texts(1)
    for text, (ids, spans) in zip(texts, encoded(model, texts), strict=True):
        assert ids == model.whole.encode(text)
        found = model.whole.encode(text, return_type="proto").pieces
        assert spans == [(x.begin, x.end) for x in found]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("collapse", [True, False])
@pytest.mark.parametrize("escape", [True, False])
def test_longest_prefixes_of_compiled_maps(rule, collapse, escape):
    """Other models' character maps: text and alignment of every character."""
    settings = {"add_dummy_prefix": collapse, "remove_extra_whitespaces": collapse, "escape_whitespaces": escape}
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, **settings)
    model = spiece.Model.__new__(spiece.Model)
    blob = b""
    for number, value in spiece._fields(library.serialized_model_proto()):
        if number == 3:
            blob = dict(spiece._fields(value)).get(2, b"") or blob
    model.map = spiece.CharacterMap(blob)
    model.prefix, model.collapse, model.escape = collapse, collapse, escape
    texts = odd_texts(2)
    normal = model.normalise(*W.text_bytes(pa.array(texts)))
    for i, text in enumerate(texts):
        want, places = library.normalize(text, with_offsets=True)
        found = normal.text(i)
        assert found == want
        at = np.cumsum([0] + [len(x.encode()) for x in found])[:-1]
        source = normal.source[normal.offsets[i] : normal.offsets[i + 1]][at]
        place = {int(x): j for j, x in enumerate(np.cumsum([0] + [len(x.encode()) for x in text]))}
        assert [place[x] for x in source.tolist()] == places[:-1]


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    model = spiece.load(PATH)
    rng = random.Random(3)
    text = "".join(rng.choice(["word", " ", "  ", "ab\n", "é", "   x"]) for _ in range(5000))
    monkeypatch.setattr(spiece, "LONG", 64)
    (ids, spans), = encoded(model, [text])
    assert len(model._parts(model.normalise(*W.text_bytes(pa.array([text]))).text(0))) > 50
    assert ids == model.whole.encode(text)
    assert spans[-1][1] == len(text.encode()) and all(a[1] <= b[1] for a, b in itertools.pairwise(spans))


def test_bytes_that_are_no_text():
    model = spiece.load(PATH)
    data = np.frombuffer("a\xff b".encode("latin-1") + "é".encode()[:1] + "é".encode()[1:] + b"\xe2\x82", np.uint8)
    offsets = np.array([0, 4, 5, 8])
    ids, begins, ends, counts = spiece.encode(model, data, offsets, False, False)
    want = [model.whole.encode(x) for x in ("a� b", "�", "���")]
    assert ids.tolist() == [x for row in want for x in row]
    assert ends[np.cumsum(counts) - 1].tolist() == [4, 1, 3]


def test_query_and_edges(spark, edges, nothing, tables):
    path = tables()
    whole = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for key, text in rows:
        ids = whole.encode(text or "", add_bos=True, add_eos=True)
        sha = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), whole.decode(ids).encode())]
        want.append((key, len(ids), *sha))
    found = queries.op13_sentencepiece(spark, path)
    assert found.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((tuple(x)[:4] for x in found.collect()), key=repr) == sorted(want, key=repr)
    assert queries.op13_sentencepiece(spark, tables(documents=nothing)).count() == 0


def test_spans_as_arrays(spark, edges):
    rows = spiece.encoded(edges, PATH, keep=["key", "doc_id"], begin=False, end=False)
    rows = rows.select("doc_id", spiece.numbers("begins").alias("b"), spiece.numbers("ends").alias("e"), spiece.numbers("ids").alias("i"))
    row = rows.where("doc_id = 12").first()
    text = next(x["text"] for x in edges.where(F.col("doc_id") == 12).collect()).encode()
    model = spiece.load(PATH)
    for begin, end, number in zip(row["b"], row["e"], row["i"], strict=True):
        piece = model.whole.id_to_piece(number)
        if not piece.startswith("<0x"):
            assert text[begin:end].decode() == piece.replace("▁", " ").removeprefix(" " if begin == 0 else "")
    assert spiece.decoded(spiece.encoded(edges.limit(0), PATH), PATH).count() == 0
