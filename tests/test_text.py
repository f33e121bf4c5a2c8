import random

import pytest
import regex
from pyspark.sql import functions as F

from textmark.functions import text as T
from textmark.operators import lookup
from textmark.operators import tokens as W

EDGES = {
    "film2": [],
    "a_b": [],
    "don't": ["don", "t"],
    "x²": ["x"],
    "żeby Łódź": ["żeby", "Łódź"],
    "ΣΑΣ": ["ΣΑΣ"],
    "": [],
    "123 45": [],
    "ab́cd ef": ["ef"],
    "́abc": ["abc"],
    "_́abc x": ["abc", "x"],
    "a1́b c": ["c"],
    "日本 語": ["日本", "語"],
    "\U0001f600a \U00010400b": ["a", "\U00010400b"],
    "one\ntwo\tthree": ["one", "two", "three"],
}


def brute_force(text):
    """Whole words first, letters-only afterwards."""
    words = regex.findall(r"(?:[\p{L}\p{Nd}]\p{Mn}*|_)+", text)
    return [word for word in words if regex.fullmatch(r"\p{L}+", word)]


def found(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r["w"] for r in rows.select(T.raw_tokens(F.col("text")).alias("w")).collect()]


def test_token_edges(spark):
    assert found(spark, list(EDGES)) == list(EDGES.values())


def test_tokens_of_random_texts(spark):
    rng = random.Random(5)
    alphabet = "abŻé1_ ́-'²日\U00010400"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(3000)]
    assert found(spark, texts) == [brute_force(t) for t in texts]


def test_a_very_long_run_is_one_pass(spark):
    assert found(spark, ["áb" * 100_000 + " end"]) == [["end"]]


def test_lower_case_comes_after_matching(spark):
    row = spark.createDataFrame([("İstanbul ABC",)], "text string")
    assert row.select(T.tokens(F.col("text")).alias("w")).first()["w"] == ["i̇stanbul", "abc"]


LEMMAS = [
    ("ran", 1, "run"),
    ("ran", 2, "ran"),
    ("saw", 2, "saw"),
    ("saw", 1, "see"),
    ("were", 1, "be"),
    ("the", 1, "this"),
]
STOPS = ["be", "the", "of"]
TEXTS = [
    (1, "Ran ran SAW unknown"),
    (2, "were the of"),
    (3, ""),
    (4, "run of run the run"),
]


@pytest.mark.parametrize(
    "filter_on, expected",
    [
        ("stem", {1: ["run", "run", "see", "unknown"], 2: ["this"], 3: [], 4: ["run", "run", "this", "run"]}),
        ("token", {1: ["run", "run", "see", "unknown"], 2: ["be"], 3: [], 4: ["run", "run", "run"]}),
    ],
)
def test_literal_lists_and_tables_agree(spark, filter_on, expected):
    texts = spark.createDataFrame(TEXTS, "doc_id long, text string")
    first = {token: stem for token, rank, stem in LEMMAS if rank == 1}
    literal = W.prepare_words(texts, "doc_id", "text", first, STOPS, filter_on)
    lemma_table = spark.createDataFrame(LEMMAS, "token string, rank int, stem string")
    stop_table = spark.createDataFrame([(w,) for w in STOPS], "word string")
    joined = W.prepare_words(texts, "doc_id", "text", lemma_table, stop_table, filter_on)
    for prepared in (literal, joined):
        assert "text" not in prepared.columns
        assert {r["doc_id"]: r["words"] for r in prepared.collect()} == expected


def test_large_word_lists_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *bounds: False)
    texts = spark.createDataFrame(TEXTS, "doc_id long, text string")
    lemma_table = spark.createDataFrame(LEMMAS, "token string, rank int, stem string")
    stop_table = spark.createDataFrame([(w,) for w in STOPS], "word string")
    joined = W.prepare_words(texts, "doc_id", "text", lemma_table, stop_table)
    assert {r["doc_id"]: r["words"] for r in joined.collect()} == {
        1: ["run", "run", "see", "unknown"],
        2: ["this"],
        3: [],
        4: ["run", "run", "this", "run"],
    }


def test_literal_preparation_does_not_shuffle(spark):
    texts = spark.createDataFrame(TEXTS, "doc_id long, text string")
    plan = W.prepare_words(texts, "doc_id", "text", {"ran": "run"}, STOPS)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_many_lemmas_find_their_stems(spark):
    lemmas = {f"w{chr(97 + i % 26)}{'x' * (i // 26)}": f"s{i}" for i in range(1500)}
    row = spark.createDataFrame([(list(lemmas),)], "words array<string>")
    assert row.select(T.stems(F.col("words"), lemmas).alias("w")).first()["w"] == list(lemmas.values())


def test_too_long_a_literal_is_refused():
    with pytest.raises(ValueError):
        T.stems(F.col, {str(i): "x" for i in range(20_000)})
    with pytest.raises(ValueError):
        T.without(F.col, {str(i) for i in range(20_000)})


def test_rating_parse(spark):
    rows = spark.createDataFrame([("7",), (" 7.5 ",), ("x",), ("",), (None,)], "r string")
    assert [r[0] for r in rows.select(T.parsed_rating(F.col("r"))).collect()] == [7.0, 7.5, None, None, None]


def test_fingerprint(spark):
    row = spark.createDataFrame([("abc",)], "t string")
    assert row.select(T.fingerprint(F.col("t"))).first()[0] == "900150983cd24fb0d6963f7d28e17f72"


def test_any_number_of_marks(spark):
    marks = "\u0301"
    texts = ["1" + n * marks + "abc def" for n in (1, 3, 20, 500)] + ["a" + 40 * marks + "b c", "_" + marks + "abc", marks + "abc"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    found = [r[0] for r in rows.orderBy("id").select(T.raw_tokens(F.col("text"))).collect()]
    assert found == [["def"]] * 4 + [["c"], ["abc"], ["abc"]]


def test_long_lists_and_repeated_keys_take_the_join(spark):
    stops = {f"w{i}" for i in range(10_001)} | {"the"}
    lemmas = {f"l{i}": "x" for i in range(10_001)} | {"cats": "cat"}
    rows = spark.createDataFrame([(1, "the cats"), (1, "cats run the"), (2, "the")], "doc_id long, text string")
    short = W.prepare_words(rows, "doc_id", lemmas={"cats": "cat"}, stop_words={"the"})
    long = W.prepare_words(rows, "doc_id", lemmas=lemmas, stop_words=stops)
    expected = [(1, ["cat", "run"]), (1, ["cat"]), (2, [])]
    for df in (short, long):
        assert sorted((r["doc_id"], r["words"]) for r in df.collect()) == sorted(expected)


def test_a_large_dictionary_shuffles_no_tokens(spark):
    lemmas = spark.range(400_000).selectExpr("concat('w', id) token", "1 rank", "concat('s', id) stem")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").crossJoin(spark.range(50))
    rows = rows.selectExpr("doc_id * 100 + id as doc_id", "concat(text, ' cats w') as text")
    lemmas = lemmas.union(spark.createDataFrame([("cats", 1, "cat"), ("w", 1, "v")], lemmas.schema))
    words = W.prepare_words(rows, "doc_id", lemmas=lemmas, stop_words=spark.createDataFrame([("v",)], "word string"))
    assert {tuple(r["words"]) for r in words.collect()} == {("a", "cat"), ("b", "cat")}
    plan = words._jdf.queryExecution().executedPlan().toString()
    assert "token" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
