import random

import pytest
from pyspark.sql import functions as F

from textmark.runtime import shared_folder, work_folder
from textmark.sources import records, reviews, samples, words

CSV = (
    "rating,text\n"
    '7,"He said ""good"""\n'
    "bad,plain\n"
    ",no rating\n"
    "5,\n"
    '9,"two\nlines"\n'
)


@pytest.fixture
def review_file(tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(CSV)
    return str(path)


def test_read_reviews(spark, review_file):
    read = [tuple(r) for r in reviews.read_reviews(spark, review_file).collect()]
    assert read == [
        (7.0, 'He said "good"'),
        (None, "plain"),
        (None, "no rating"),
        (5.0, None),
        (9.0, "two\nlines"),
    ]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _random_csv(rng, rows):
    """Fields with breaks, quotes and commas, among them one far longer than a split."""
    signs = ['"', "\n", ",", "\r\n", "a", "bc", " ", "ż", "\\"]
    lines = ["rating,text,more"]
    for row in range(rows):
        text = "".join(rng.choices(signs, k=rng.choice([0, 3, 30, 400 if row % 9 == 0 else 5])))
        quoted = '"' + text.replace('"', '""') + '"'
        bare = "plain" + rng.choice(["", ' with a "quote" inside', '"', " x"])
        lines.append(f"{row},{quoted},{bare}")
    return "\n".join(lines) + rng.choice(["", "\n"])


def test_records_are_cut_by_many_tasks(spark, small_splits, tmp_path):
    rng = random.Random(5)
    for name in range(4):
        (tmp_path / f"{name}.csv").write_bytes(_random_csv(rng, 60).encode())
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 12
    read = reviews.read_reviews(spark, str(tmp_path)).select("rating", "text", "more")
    whole = spark.read.csv(
        str(tmp_path), header=True, escape='"', multiLine=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).select(F.col("rating").cast("double"), "text", "more")
    assert sorted(map(repr, read.collect())) == sorted(map(repr, whole.collect()))


def test_quotes_that_never_close_end_with_the_file(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_text("rating,text\n1,ok\n2,\"open\n" + "3,lost\n" * 40)
    (tmp_path / "b.csv").write_text("rating,text\n4,fine\n")
    read = {r["rating"]: r["text"] for r in reviews.read_reviews(spark, str(tmp_path)).collect()}
    assert set(read) == {1.0, 2.0, 4.0} and read[2.0].count("lost") == 40


@pytest.mark.parametrize(
    ("line", "closed", "opened"),
    [
        ("a,b", False, True),
        ('a,"b', True, False),
        ('a "b,c', False, False),
        ('"a""b"', False, False),
        ('"a"",b', True, False),
        ('x",y', False, False),
        ('x","y', True, True),
        ("", False, True),
    ],
)
def test_state_after_a_line(line, closed, opened):
    assert (records.stays_open(line, False), records.stays_open(line, True)) == (closed, opened)


def test_rejected_records_keep_their_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('rating,text\n7,good\nbad,"two\nlines"\n8,one,more\n9\n,\n')
    found = {r[0]: tuple(r)[1:] for r in reviews.rejects(spark, str(tmp_path)).collect()}
    assert found == {
        'bad,"two\nlines"': (False, True, False),
        "8,one,more": (True, False, False),
        "9": (True, False, True),
        ",": (False, True, True),
    }


def test_other_headers_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("rating,text\n1,a\n")
    (tmp_path / "b.csv").write_text("text,rating\na,1\n")
    with pytest.raises(ValueError, match="different headers"):
        reviews.read_reviews(spark, str(tmp_path))


def test_rejected(spark, review_file):
    row = reviews.rejected(reviews.read_reviews(spark, review_file)).first()
    assert tuple(row) == (5, 2, 1, 3)


def test_single_line_reading_cuts_texts(spark, review_file):
    read = reviews.read_reviews(spark, review_file, multi_line=False).dropna()
    assert [r["text"] for r in read.collect()] == ['He said "good"', "two"]


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "indexed.csv"
    path.write_text(",rating,text\n0,7.0,fine\n")
    row = reviews.read_reviews(spark, str(path)).first()
    assert (row["rating"], row["text"]) == (7.0, "fine")
    assert tuple(reviews.read_positional(spark, str(path)).first()) == (0.0, "7.0")


def test_missing_column(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        reviews.read_reviews(spark, str(path))


def test_keys_are_unique_and_stay(spark, review_file):
    keyed = reviews.with_key(reviews.read_reviews(spark, review_file).repartition(3))
    first = {(r["doc_id"], r["text"]) for r in keyed.collect()}
    assert len({key for key, _ in first}) == 5
    assert {(r["doc_id"], r["text"]) for r in keyed.repartition(2).collect()} == first


def test_round_trip_keeps_texts(spark, folder):
    texts = ['a "b" c', " padded ", "line\nbreak", "cr\r\nlf", "comma, here", "back\\slash", "żółć", ""]
    rows = spark.createDataFrame([(float(i), t) for i, t in enumerate(texts)], "rating double, text string")
    reviews.write_csv(rows, folder + "/out")
    read = reviews.read_reviews(spark, folder + "/out")
    assert {r["rating"]: r["text"] or "" for r in read.collect()} == dict(enumerate(texts))


def test_results_round_trip(spark, folder):
    rows = spark.createDataFrame([(1.0, 2.0), (9.5, None)], "prediction double, label double")
    reviews.write_csv(rows, folder + "/out")
    assert {tuple(r) for r in reviews.read_results(spark, folder + "/out").collect()} == {(1.0, 2.0), (9.5, None)}


def test_word_list(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("a\nże\na\n")
    listed = words.read_word_list(spark, str(path))
    assert words.small_word_set(listed) == {"a", "że"}


def test_lemma_file(spark, tmp_path):
    path = tmp_path / "lemmas.tsv"
    path.write_text("ran\t1\trun\nran\t2\tran\n")
    assert [tuple(r) for r in words.read_lemmas(spark, str(path)).collect()] == [("ran", 1, "run"), ("ran", 2, "ran")]


def test_sample_files(spark, tmp_path):
    for mark in (1, 10):
        (tmp_path / f"review_{mark}.txt").write_text(f"text {mark}\nsecond line\n")
    read = samples.read_sample_files(spark, str(tmp_path / "review_*.txt"))
    assert {r["mark"]: r["text"] for r in read.collect()} == {
        1: "text 1\nsecond line\n",
        10: "text 10\nsecond line\n",
    }


def test_work_folders_are_below_the_shared_one(spark):
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first != second and first.startswith(shared_folder(spark))


def test_keys_follow_the_content(spark):
    rows = spark.createDataFrame([(1.0, "a"), (1.0, "a"), (None, "a"), (1.0, None), (2.0, "b")] * 3, "rating double, text string")
    one, two = (sorted(map(tuple, reviews.with_key(rows.repartition(n)).collect()), key=repr) for n in (1, 7))
    assert one == two and len({r[-1] for r in one}) == 15


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077", "yarn", "k8s://https://host"])
def test_a_cluster_needs_a_shared_folder(master):
    class Session:
        conf = {}
        sparkContext = type("Context", (), {"master": master})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
