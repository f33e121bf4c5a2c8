"""Operators on single texts against brute force: op2, op5, op6, op7, op8, op9, op10."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textmark.llm import decontaminate, language, lm, packing, pii, quality, queries, secret_scan
from textmark.llm.labelled import fold, sampled

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Packing


def fill(plan, counts):
    out = {}
    rows = sorted(plan.rows)
    for length, count in counts.items():
        own = [r for r in rows if r[0] == length]
        for rank in range(count):
            _, first, sequence, each, offset = [r for r in own if r[1] <= rank][-1]
            nth = rank - first
            out.setdefault(sequence + nth // each, []).append((offset + nth % each * length, length))
    return out


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in {x: k for k, x in enumerate(bins) if x >= items[i]}.values():
            bins[b] -= items[i]
            go(i + 1, bins)
            bins[b] += items[i]
        bins.append(capacity - items[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_reduction_keeps_the_optimum(items):
    counts = Counter(items)
    rest, plan = dict(counts), packing.Plan(20)
    fixed = packing.reduce(rest, plan)
    left = [x for x, n in rest.items() for _ in range(n)]
    assert fixed + (fewest(left, 20) if left else 0) == fewest(items, 20)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=25))
def test_plan_places_every_piece_without_gaps(counts):
    plan = packing.solve(counts, 50)
    found = fill(plan, counts)
    assert sorted(found) == list(range(plan.sequences))
    for pieces in found.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 50


def tokenizer():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def check_packed(rows, texts):
    """Ids, cuts and gapless places of the pieces of ``texts``, given as (key, text)."""
    whole = tokenizer()
    expected = Counter()
    for key, text in texts:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        for number, (start, n) in enumerate(packing.cuts(len(ids), 2048)):
            assert n == 2048 or start == 0
            crc = zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
            expected[key, number, start, n, crc] += 1
    assert Counter(tuple(x[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for x in rows) == expected
    places = {}
    for x in rows:
        places.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    return len(places)


def test_packing_query_and_edges(spark, edges, nothing, tables):
    assert check_packed(queries.op2_packing(spark, tables()).collect(), TEXTS) > 0
    assert queries.packed(nothing).collect() == []
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op2_packing(spark, SMALL).collect()
    used = check_packed(rows, [tuple(x) for x in docs])
    assert used <= 1.01 * math.ceil(sum(x["length"] for x in rows) / 2048) + 1


def test_both_tokenizers_agree():
    import public_tokenizers as P

    encode = packing.Encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rng = random.Random(4)
    plain = "abcXYZ019 \t\n\r.,;'\"!?-_ąćęłńóśźżäöüßéèàñ¿¡×÷ªº²½µ"
    for _ in range(3000):
        text = "".join(rng.choice(plain) for _ in range(rng.randint(0, 30)))
        assert encode.ids(text).tolist() == encode.whole.encode(text, add_special_tokens=False).ids
    for text in ("<|endoftext|>", "a<|endoftext|>b", "日本語 \u0085", "\U0001f600‍", "\x1c\x00"):
        assert encode.ids(text).tolist() == encode.whole.encode(text, add_special_tokens=False).ids


# Language model


def test_lm_counts_and_normalisation(spark, edges, tables, nothing):
    rows = queries.op5_lm_scores(spark, tables()).collect()
    words = [[*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), None] for _, t in TEXTS]
    learn = [k is not None and zlib.crc32(str(k).encode()) % 10 != 0 for k, _ in TEXTS]
    count = Counter(w for ws, own in zip(words, learn, strict=True) if own for w in ws)
    total, distinct = sum(count.values()), len(count)
    expected = Counter()
    for (key, _), ws in zip(TEXTS, words, strict=True):
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        expected[key, len(ws), sum(count[w] > 0 for w in ws), total, round(base, 4)] += 1
    assert Counter((x["doc_id"], x["n_tokens"], x["n_known"], x["train_tokens"], round(x["base_score"], 4)) for x in rows) == expected
    assert all(math.isfinite(x["score"]) and x["score"] < 0 for x in rows)
    assert lm.scores(nothing, F.lit(True)).collect() == []
    untrained = lm.scores(edges, F.lit(False)).collect()
    assert all(x["base_score"] == x["score"] == 0 and x["train_tokens"] == 0 for x in untrained)


def test_lm_rare_words_take_the_join(spark):
    """A small table of frequent words changes nothing but the plan."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    few = {x["doc_id"]: x for x in lm.scores(docs, fold("doc_id", 10) != 0, heavy=700).collect()}
    many = {x["doc_id"]: x for x in lm.scores(docs, fold("doc_id", 10) != 0).collect()}
    assert few.keys() == many.keys()
    for key, x in few.items():
        assert x["n_known"] == many[key]["n_known"]
        assert x["base_score"] == pytest.approx(many[key]["base_score"], rel=1e-9)
        assert x["score"] == pytest.approx(many[key]["score"], rel=1e-3)


@pytest.mark.parametrize("heavy", [0, 3, 40])
def test_lm_knows_the_end_in_few_long_texts(spark, heavy):
    """Ends are rarer than many words here, and still counted."""
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(words * (5 + k)) for k in range(3)] + ["", None, "w1 unseen"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    learned = F.col("doc_id") < 3
    count = Counter(w for text in texts[:3] for w in [*text.split(), None])
    total, distinct = sum(count.values()), len(count)
    for x in lm.scores(docs, learned, heavy=heavy).collect():
        own = [*(texts[x["doc_id"]] or "").split(), None]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert (x["n_tokens"], x["n_known"]) == (len(own), sum(count[w] > 0 for w in own))
        assert x["train_tokens"] == total and x["base_score"] == pytest.approx(base, rel=1e-9)
        assert math.isfinite(x["score"]) and x["score"] < 0


def test_lm_probabilities_sum_to_one_and_learn():
    rng = np.random.default_rng(0)
    counts = rng.integers(1, 50, 12)
    vocabulary = lm.Vocabulary(np.arange(12, dtype=np.uint64), counts, int(counts.sum()), 12, 8)
    s = vocabulary.classes
    shares = vocabulary.class_counts()
    start = lm.initial(shares, 6)
    two, one, of = np.meshgrid(*[np.arange(s)] * 3, indexing="ij")
    codes = ((two * s + one) * s + of).ravel()
    n = (1 + 40 * (of == (one + 1) % s)).ravel()
    better = lm.improved(start, codes, n, shares / shares.sum(), passes=60, rate=0.1)
    for w in (start, better):
        p = 10 ** lm.Model(vocabulary, w).log10(of, one, two)
        assert np.allclose(p.sum(2), 1, atol=1e-4)
    before, after = (lm.Model(vocabulary, w).log10(of, one, two).ravel() @ n for w in (start, better))
    assert after > before


def test_lm_beats_counts_on_held_out_texts(spark):
    rows = queries.op5_lm_scores(spark, "/root/testdata/sf0.01").where("held_out")
    x = rows.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert x["score"] > x["base"]


# Decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_contamination(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for key, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        names = sorted(str(x) for x in found if x is not None)
        sha = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(names), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


ITEMS = [(1, None), (2, ""), (3, "word word"), (4, "one TWO three"), (None, "żółć"), (5, " ".join("abcdefghijklmnopqrst")),
         (5, " ".join("ABCDEFGHIJKLMNOPQRST")), (6, "word " * 20), (10, "a b c d e f g h i j k l m")]


def test_decontamination_edges(spark, edges, tables, nothing):
    items = spark.createDataFrame([(*x, 1) for x in ITEMS], "item_id long, text string, doc_id long")
    found = queries.op6_decontamination(spark, tables(benchmark=items)).collect()
    assert sorted((tuple(x) for x in found), key=repr) == brute_contamination(TEXTS, ITEMS)
    empty = decontaminate.contamination(items.limit(0))
    rows = edges.select(empty(F.col("text")).alias("r")).collect()
    assert len(rows) == len(TEXTS) and all(x["r"]["n_hit"] == 0 for x in rows)
    assert nothing.select(empty(F.col("text"))).collect() == []


@pytest.mark.parametrize("block_words", [12, 1_000_000])
def test_every_shared_window_is_found(spark, tables, block_words):
    rng = random.Random(block_words)
    alphabet = [f"w{i}" for i in range(4)]  # few words: many equal hashes
    items = [(i, " ".join(rng.choice(alphabet) for _ in range(rng.choice([3, 8, 13, 14, 30])))) for i in range(25)]
    docs = []
    for i in range(120):
        words = [rng.choice(alphabet + ["x", "y"]) for _ in range(rng.randint(0, 60))]
        item = rng.choice(items)[1].split()
        cut = rng.randint(0, len(item))
        at = rng.randint(0, len(words))
        docs.append((i, " ".join(words[:at] + item[cut : cut + rng.choice([12, 13, 30])] + words[at:])))
    found = decontaminate.contamination(spark.createDataFrame(items, "item_id long, text string"), block_words=block_words)
    rows = spark.createDataFrame(docs, "doc_id long, text string").select("doc_id", found(F.col("text")).alias("r"))
    got = sorted(
        ((x["doc_id"], x["r"]["n_words"], x["r"]["n_hit"], len(x["r"]["items"]),
          hashlib.sha256(",".join(x["r"]["items"]).encode()).hexdigest(),
          x["r"]["n_hit"] > 0 and 20 * x["r"]["n_hit"] >= x["r"]["n_words"]) for x in rows.collect()), key=repr
    )
    assert got == brute_contamination(docs, items)
    for x in rows.collect():
        assert sum(s["stop"] - s["start"] for s in x["r"]["spans"]) == x["r"]["n_hit"]


# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_pii(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = [c for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=1500, deadline=None)
@given(st.one_of(
    st.text(alphabet="0129 .-@+()aé%", max_size=40),
    st.lists(st.sampled_from(["4111 1111 1111 1111", "4111111111111111", "1", "0", " ", "-", "+", ".", "@", "a", "255", "256"]), max_size=9).map("".join),
))
def test_base_spans_are_those_of_the_patterns(text):
    found = [x for x in pii.spans_of(text, pii._shared()) if x[0] in pii.BASE]
    assert found == brute_pii(text)


def test_pii_query_and_edges(spark, edges, tables, nothing):
    rows = queries.op7_pii(spark, tables()).collect()
    expected = Counter()
    for key, text in TEXTS:
        base = brute_pii(text)
        count = Counter(x[0] for x in base)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        expected[key, *(count[k] for k in PATTERNS), hashlib.sha256(joined.encode()).hexdigest()] += 1
    assert Counter(tuple(x)[:6] for x in rows) == expected
    assert nothing.select(pii.find(F.col("text"))).collect() == []
    kept = edges.select("text", pii.redact(F.col("text")).alias("r")).collect()
    assert all((x["text"] is None) == (x["r"] is None) for x in kept)
    assert kept[-1]["r"].endswith("mail: <email> oraz <phone>")


def test_added_spans_and_redaction():
    text = "IBAN: DE89 3704 0044 0532 0130 00, account no 12345678; https://bob:x@h.de/a. https://10.0.0.1/x https://e.com account x"
    spans = pii.spans_of(text, pii._shared())
    assert [text[a:b] for k, a, b in spans if k == "account"] == ["DE89 3704 0044 0532 0130 00", "12345678"]
    assert [text[a:b] for k, a, b in spans if k == "url"] == ["https://bob:x@h.de/a", "https://10.0.0.1/x"]
    assert pii.redacted(text, spans) == "IBAN: <account>, account no <account>; <url>. <url> https://e.com account x"


# Secrets


def test_repeated_schemes_cost_the_length_of_the_text():
    automaton = pii._automaton()
    start = time.perf_counter()
    for text in ("http://" * 150_000, "http://a@" * 120_000, "http://1.2.3" * 90_000):
        pii.spans_of(text, automaton)
    assert time.perf_counter() - start < 30  # minutes, were each scheme to read on to the next blank
    text = "x http://u:p@h/?@ http://1.2.3.4:80/a, http://1.2.3.400/ http://a/b@c https://9.8.7.6"
    urls = [text[a:b] for kind, a, b in pii.spans_of(text, automaton) if kind == "url"]
    assert urls == ["http://u:p@h/?@", "http://1.2.3.4:80/a", "https://9.8.7.6"]


def test_secret_findings_forest_and_edges(spark, nothing):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        token = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        rows.append((2 * i, f'é some words token = "{token}" and more', "src/a"))
        rows.append((2 * i + 1, "thisisalongwordwithoutanysecretvalue in a text " * rng.randint(1, 3), "src/test"))
    rows += [(None, None, None), (1000, "", None), (1001, "x " * 50_000 + "password: hunter2secret9", None)]
    docs = spark.createDataFrame([(*r, 0, 0.5) for r in rows], "doc_id long, text string, source string, row long, probability double")
    found = secret_scan.described(secret_scan.findings(docs.where("doc_id < 400 or doc_id is null"))).withColumn("label", secret_scan.weak_label())
    forest = secret_scan.train(found)
    out = secret_scan.scan(docs, forest).collect()
    text = {k: t for k, t, _ in rows}
    assert all(text[x["doc_id"]][x["start"] :].startswith(x["candidate"]) for x in out)
    held = [x for x in out if 400 <= x["doc_id"] < 1000]
    assert len({x["doc_id"] for x in held}) == 200
    assert sum(x["is_secret"] == (x["doc_id"] % 2 == 0) for x in held) >= 0.99 * len(held)
    assert "hunter2secret9" in {x["candidate"] for x in out}
    assert secret_scan.scan(nothing, forest).collect() == []
    assert secret_scan.train(found.where("label = 1")).model is None
    assert "Python" not in secret_scan.scan(docs, forest)._jdf.queryExecution().toString()


def test_secret_findings_of_prefixed_and_quoted_cues(spark, nothing):
    forms = {
        "DB_PASSWORD=hunter2x!": "hunter2x!", "client_secret: s3cr3t-v4lue": "s3cr3t-v4lue", "my_api_key=abc12345!x@y": "abc12345!x@y",
        '{"password": "hunter22"}': "hunter22", "{'auth-token':'tok-12345'}": "tok-12345", "export A_LONG_SERVICE_NAME_PASSWORD=hunter2x!": "hunter2x!",
        '"a_long_service_name_password": "hunter22"': "hunter22", "token=0123456789abcdef0123456789abcdef": "0123456789abcdef0123456789abcdef",
        "x " * 10 + "MY-SECRET = 'p4ssw0rd,'": "p4ssw0rd,", "AB12" * 20_000 + " pwd=s3cr3t-v4lue": "s3cr3t-v4lue",
    }
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(forms)], "doc_id long, text string, source string")
    found = secret_scan.described(secret_scan.findings(docs)).withColumn("label", secret_scan.weak_label()).collect()
    for i, (text, value) in enumerate(forms.items()):
        hits = [x for x in found if x["key"] == i and x["candidate"] == value]
        assert len(hits) == 1, text
        assert text[hits[0]["start"] :].startswith(value)
        assert hits[0]["cue"] == hits[0]["assigned"] == hits[0]["label"] == 1, text
    assert max(len(x["candidate"]) for x in found) == 80_000


# Language and quality


def test_language_learns_and_edges(spark, edges, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = queries.op9_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "n_chars"), "doc_id")
    held = found.where("held_out and n_chars > 200").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held >= 0.97
    assert found.where("score < 0 or score > 1 or score is null").count() == 0
    net = language.fit(docs)
    rows = edges.select("text", language.predictor(net)("text").alias("r")).collect()
    for x in rows:
        lettered = any(c.isalpha() for c in x["text"] or "")
        assert (x["r"]["language"] == language.UNKNOWN) != lettered
    assert nothing.select(language.predictor(net)("text")).collect() == []
    assert language.fit(nothing) is None
    assert {x["r"]["language"] for x in edges.select(language.predictor(None)("text").alias("r")).collect()} == {"und"}


def test_language_fast_path_equals_plain_convolution():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 256, (20, language.WINDOW)).astype(np.uint8)
    net = language.train(rows, rng.integers(0, 3, 20), ["a", "b", "c"], epochs=1)
    embedded = net.w["embed"][rows]
    plain = []
    for k in language.WIDTHS:
        answers = [embedded[:, i : i + k].reshape(20, -1) @ net.w[f"conv{k}"] for i in range(language.WINDOW - k + 1)]
        plain.append(np.max(answers, axis=0))
    assert np.allclose(net.pooled(rows), np.concatenate(plain, axis=1), atol=1e-4)


def numeric_gradient(loss, w, name, at, step=1e-3):
    w[name][at] += step
    up = loss()
    w[name][at] -= 2 * step
    down = loss()
    w[name][at] += step
    return (up - down) / (2 * step)


def test_gradients_by_difference():
    rng = np.random.default_rng(8)
    rows, y = rng.integers(0, 256, (6, language.WINDOW)).astype(np.uint8), rng.integers(0, 3, 6)
    net = language.train(rows, y, ["a", "b", "c"], epochs=0)
    net.w = {k: x.astype(np.float64) for k, x in net.w.items()}
    g = net.gradient(rows, y)
    loss = lambda: -net._head(net.pooled(rows))[np.arange(6), y].mean()
    for name, at in (("out", (0, 1)), ("conv3", (2, 3)), ("bias", (5,)), ("out_b", (2,))):
        assert numeric_gradient(loss, net.w, name, at, 1e-5) == pytest.approx(g[name][at], abs=1e-4)

    bags = [rng.random((n, quality.FEATURES)).astype(np.float64) for n in (1, 3, 5)]
    x, counts, y = np.concatenate(bags), np.array([1, 3, 5]), np.array([0, 1, 1])
    model = quality.train(bags, y, epochs=1)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    g = model.gradient(x, counts, y)

    def log_loss():
        p = model.forward(x, counts)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, at in (("enc", (3, 2)), ("att", (1, 2)), ("gate", (2, 1)), ("pick", (3,)), ("out", (4,)), ("enc_b", (0,))):
        assert numeric_gradient(log_loss, model.w, name, at, 1e-5) == pytest.approx(g[name][at], abs=1e-4)


def test_quality_learns_and_edges(spark, edges, nothing):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = queries.op10_quality(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] >= 0.95
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = quality.fit(docs, labels)
    rows = edges.select("text", quality.scorer(model)("text").alias("s")).collect()
    assert all(0 <= x["s"] <= 1 for x in rows)
    assert len({x["s"] for x in rows if not x["text"]}) == 1
    by_text = {}
    for x in rows:
        assert by_text.setdefault(x["text"], x["s"]) == x["s"]
    assert nothing.select(quality.scorer(model)("text")).collect() == []
    assert quality.fit(docs, labels.limit(0)).constant == 0.5
    assert quality.fit(docs, labels.where("quality = 1")).constant == 1.0


def test_quality_trains_on_every_passage(spark, monkeypatch):
    """No passage of a sampled text is left out, however long the text."""
    texts = {1: "plain words here. " * 2000, 2: "a", 3: "x " * 30_000 + "!!!! $$$$ " * 40 + "x " * 9_000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id long, quality int")
    seen = {}
    monkeypatch.setattr(quality, "train", lambda bags, labels: seen.update(bags=[len(x) for x in bags]))
    quality.fit(docs, labels)
    assert seen["bags"] == [-(-len(t) // quality.PASSAGE) for t in texts.values()]


def test_quality_samples_are_bound_by_passages(spark, monkeypatch):
    texts = [(i, "word " * (2000 if i == 0 else 150 * (1 + i % 3))) for i in range(40)] + [(3, "again " * 300), (None, "x")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda bags, labels: seen.append((sum(map(len, bags)), labels.tolist())))
    for most in (30, 30, 10_000):
        quality.fit(docs, labels, most=most)
    assert seen[0] == seen[1] and 20 <= seen[0][0] <= 30 and set(seen[0][1]) == {0, 1}
    assert len(seen[2][1]) == 41  # both rows of a repeated key


def test_quality_scores_beside_plain_loops():
    """Attention and score of every text, one passage and one unit at a time."""
    rng = np.random.default_rng(9)
    bags = [rng.random((n, quality.FEATURES)).astype(np.float32) for n in (1, 4, 2)]
    model = quality.train(bags, np.array([0, 1, 1]), epochs=3)
    w = {k: v.tolist() for k, v in model.w.items()}
    product = lambda row, matrix, j: math.fsum(x * r[j] for x, r in zip(row, matrix, strict=True))
    for bag, score in zip(bags, model.score(np.concatenate(bags), np.array([1, 4, 2])), strict=True):
        hidden, energy = [], []
        for row in bag.tolist():
            h = [math.tanh(product(row, w["enc"], j) + w["enc_b"][j]) for j in range(quality.ENCODED)]
            gated = [
                math.tanh(product(h, w["att"], j)) / (1 + math.exp(-product(h, w["gate"], j))) * w["pick"][j]
                for j in range(quality.GATED)
            ]
            hidden.append(h)
            energy.append(math.exp(sum(gated)))
        z = [sum(e * h[j] for e, h in zip(energy, hidden, strict=True)) / sum(energy) for j in range(quality.ENCODED)]
        plain = 1 / (1 + math.exp(-sum(a * b for a, b in zip(z, w["out"], strict=True)) - w["out_b"][0]))
        assert score == pytest.approx(plain, abs=1e-5)


def test_samples_are_bounded_and_repeat(spark):
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.expr("case when id % 10 = 0 then null when id % 3 = 0 then 'a' else 'b' end").alias("l"))
    rows = rows.union(rows).union(spark.sql("select null, 'a'"))
    one = sorted(map(tuple, sampled(rows, "k", "l", 500).collect()))
    two = sorted(map(tuple, sampled(rows.repartition(7), "k", "l", 500).collect()))
    assert one == two and Counter(x[1] for x in one) == {"a": 500, "b": 500}
    assert sampled(rows, "k", "l", 10**6).count() == 18_000
