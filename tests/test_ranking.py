"""Positions, cutoffs and joins against brute force, with hot groups."""

import hashlib

import pytest
from pyspark.sql import functions as F

from textmark.functions.keys import share_limit
from textmark.operators import lookup, ranking, sampling


def digest(key, salt=""):
    return hashlib.md5(f"{salt}{key}".encode()).hexdigest()


def in_order(keys, salt=""):
    return sorted(keys, key=lambda key: (digest(key, salt), key))


@pytest.fixture(scope="module")
def rows(spark):
    # One class holds most rows.
    data = [(i, 0.0 if i % 10 else float(1 + i % 3)) for i in range(3000)]
    return spark.createDataFrame(data, "doc_id long, label double").repartition(7)


def by_class(rows):
    classes = {}
    for row in rows.collect():
        classes.setdefault(row["label"], []).append(row["doc_id"])
    return classes


def test_hash_positions(rows):
    ranked = ranking.hash_positions(rows, "doc_id", ["label"], "s", "place", total="size")
    expected = {
        (key, label, place, len(keys))
        for label, keys in by_class(rows).items()
        for place, key in enumerate(in_order(keys, "s"), 1)
    }
    assert {tuple(r) for r in ranked.collect()} == expected


def test_shuffle_positions_and_order(rows):
    expected = in_order([r["doc_id"] for r in rows.collect()], "1234")
    placed = sampling.shuffle_positions(rows.select("doc_id"), "doc_id").collect()
    assert [r["doc_id"] for r in sorted(placed, key=lambda r: r["position"])] == expected
    ordered = sampling.seeded_order(rows, "doc_id").collect()
    assert [r["doc_id"] for r in ordered] == expected


def test_balance(rows):
    classes = by_class(rows)
    smallest = min(map(len, classes.values()))
    expected = {(key, label) for label, keys in classes.items() for key in in_order(keys)[:smallest]}
    assert {tuple(r) for r in sampling.balance(rows, "doc_id").collect()} == expected


def test_balance_of_equal_classes_keeps_all(spark):
    rows = spark.createDataFrame([(i, float(i % 2)) for i in range(40)], "doc_id long, label double")
    assert sampling.balance(rows, "doc_id").count() == 40


def test_stratified_split(rows):
    expected = {
        (key, label, place < int(0.6 * len(keys)))
        for label, keys in by_class(rows).items()
        for place, key in enumerate(in_order(keys, "x"))
    }
    split = sampling.stratified_split(rows, "doc_id", salt="x")
    assert {tuple(r) for r in split.collect()} == expected


def test_stratified_split_of_tiny_classes(spark):
    rows = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 1.0)], "doc_id long, label double")
    chosen = [r["label"] for r in sampling.stratified_split(rows, "doc_id").where("in_train").collect()]
    assert chosen == [1.0]


def test_split_is_a_partition(rows):
    train, test = sampling.split(rows, "doc_id", "salt")
    train_keys = {r["doc_id"] for r in train.collect()}
    test_keys = {r["doc_id"] for r in test.collect()}
    assert not train_keys & test_keys and len(train_keys | test_keys) == 3000
    assert train_keys == {k for k in range(3000) if digest(k, "salt")[:8] < share_limit(0.6)}
    assert 0.55 < len(train_keys) / 3000 < 0.65


def test_random_split_is_seeded(rows):
    first, _ = sampling.random_split(rows, 7)
    again, rest = sampling.random_split(rows, 7)
    assert {r[0] for r in first.collect()} == {r[0] for r in again.collect()}
    assert again.count() + rest.count() == 3000


def test_share_bounds():
    with pytest.raises(ValueError):
        share_limit(1.0)


def test_row_index(rows):
    numbered = ranking.row_index(rows, [F.desc("label"), "doc_id"]).collect()
    data = sorted(rows.collect(), key=lambda r: (-r["label"], r["doc_id"]))
    assert {(r["doc_id"], r["idx"]) for r in numbered} == {(r["doc_id"], i) for i, r in enumerate(data)}


def test_row_index_of_nothing(spark):
    assert ranking.row_index(spark.range(0).toDF("a"), ["a"]).count() == 0


@pytest.mark.parametrize("bound", [1, 10_000])
def test_limit_in_order_both_ways(rows, monkeypatch, bound):
    monkeypatch.setattr(ranking, "TOP_K_ROWS", bound)
    kept = ranking.limit_in_order(rows, [F.desc("label"), "doc_id"], 450)
    data = sorted(rows.collect(), key=lambda r: (-r["label"], r["doc_id"]))[:450]
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in data}


def test_positional_pair_drops_the_surplus(spark):
    left = spark.createDataFrame([(c,) for c in "cabd"], "name string")
    right = spark.createDataFrame([(2.0,), (1.0,)], "mark double")
    paired = sampling.pair_by_position(left, right, ["name"], ["mark"])
    assert {tuple(r) for r in paired.collect()} == {(0, "a", 1.0), (1, "b", 2.0)}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_a_join(spark, how):
    # Key 0 holds most rows of the large side.
    large = spark.range(2000).select("id", F.when(F.col("id") % 3 != 0, 0).otherwise(F.col("id") % 50).alias("k"))
    small = spark.createDataFrame([(k, f"v{k}") for k in range(0, 40)], "k int, v string")
    plain = large.join(small, ["k"], how)
    salted = lookup.salted_join(large, small, ["k"], how, ["id"])
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_salt_splits_a_hot_key(spark):
    large = spark.range(10_000).select("id", F.lit(1).alias("k"))
    salts = large.select(F.pmod(F.xxhash64("id"), F.lit(lookup.SALTS)).alias("s")).groupBy("s").count()
    counts = [r["count"] for r in salts.collect()]
    assert len(counts) == lookup.SALTS and max(counts) < 2 * min(counts)


def test_lookup_join_beyond_the_bound_does_not_broadcast(spark):
    large = spark.range(100).withColumn("k", F.col("id") % 5)
    small = spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    assert lookup.fits_broadcast(small) and not lookup.fits_broadcast(small, max_rows=4)
    assert not lookup.fits_broadcast(small, max_bytes=10)
    joined = lookup.lookup_join(large, small, ["k"], "left", ["id"], max_rows=4)
    assert joined.count() == 100 and joined.where("v = 'x'").count() == 100


def test_many_classes_split_without_a_broadcast(spark, monkeypatch):
    from textmark.operators import sampling

    rows = spark.range(4000).select(F.col("id").alias("key"), (F.col("id") % 400).alias("label"))
    wide = sampling.stratified_split(rows, "key").where("in_train").count()
    monkeypatch.setattr(sampling, "fits_broadcast", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = sampling.stratified_split(rows, "key")
        assert split.where("in_train").count() == wide == 2400
        assert "BroadcastHashJoin" not in split._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
