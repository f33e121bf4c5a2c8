"""Hard negatives beside brute force, and how far sorted access goes."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmark.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<double>, label int, row long, shard long, kind long, windows string, anchor string"


def brute(rows, anchor, k=5, n=3, least=50, most=95):
    sound = [
        (key, [math.floor(256 * x) for x in v], label)
        for key, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    last = lambda key: (key is None, key or 0)
    out = []
    for i, (key, v, label) in enumerate(sound):
        if key is None or not anchor(key):
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w, strict=True)), last(other), j, other, same == label)
            for j, (other, w, same) in enumerate(sound)
            if j != i and len(w) == len(v)
        ]
        scored.sort()
        for minus, _, _, positive, _ in [x for x in scored if x[4]][:k]:
            p = -minus
            fit = [x for x in scored if not x[4] and least * p <= -100 * x[0] <= most * p][:n]
            out += [(key, positive, rank, x[3], p, -x[0]) for rank, x in enumerate(fit, 1)]
    return sorted(out, key=repr)


def vectors(seed, n=160, width=6):
    """Clusters, copies, ties, and everything that takes no part."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        v = [round(x + rng.gauss(0, 0.15), 1) for x in rng.choice(centres)]
        rows.append((rng.randint(0, n), v, rng.randint(0, 2)))
    rows += rows[:10] + [(5, rows[0][1], 1), (10, rows[0][1], 2), (None, rows[1][1], 1), (None, rows[1][1], 2)]
    rows += [(15, None, 1), (20, [0.1] * width, None), (25, [0.1, None, *[0.2] * (width - 2)], 1)]
    rows += [(30, [float("nan")] * width, 1), (35, [float("inf")] * width, 2), (40, [0.0] * width, 1), (45, [], 1), (50, [], 2)]
    rows += [(55, [0.3, 0.2], 1), (60, [0.3, 0.1], 1), (65, [0.2, 0.1], 2), (70, [-0.2, -0.1], 2)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, 1, 2, 3, "w", "a") for x in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize(("seed", "shard", "together"), [(1, 8, 3), (2, 64, 64), (3, 8192, 64)])
def test_every_negative_of_brute_force(spark, monkeypatch, seed, shard, together):
    monkeypatch.setattr(negatives, "DEPTH", 4)
    monkeypatch.setattr(negatives, "TOGETHER", together)
    rows = vectors(seed)
    found = negatives.mined(frame(spark, rows), F.col("label"), F.col("vec_id") % 5 == 0, shard=shard)
    assert sorted((tuple(x) for x in found.collect()), key=repr) == brute(rows, lambda key: key % 5 == 0)


def test_query_and_edges(spark, tables):
    rows = vectors(4)
    path = tables(embeddings=frame(spark, rows))
    relabelled = [(k, v, (label + 1) % 10 if k is not None and k % 7 == 0 and label is not None else label) for k, v, label in rows]
    found = queries.op12_hard_negatives(spark, path)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted((tuple(x) for x in found.collect()), key=repr) == brute(relabelled, lambda key: key % 50 == 0)
    assert queries.op12_hard_negatives(spark, tables(embeddings=frame(spark, rows).limit(0))).count() == 0


def test_access_stops_early_and_loses_nothing():
    rng = np.random.default_rng(5)
    base = rng.integers(-4, 5, (3000, 1)) * np.array([[9, -7, 5, 3]]) * 20
    matrix = (base + rng.integers(-3, 4, (3000, 4))).astype(np.int64)
    ids = np.arange(3000)
    lists = negatives.Lists(ids, ids, ids % 2, matrix)
    low, high = np.array([-(1 << 62)]), np.array([1 << 62])
    early = 0
    for i in range(0, 3000, 300):
        ((place, score),), met = lists.best(matrix[i], lists.labels == 1, low, high, 5)
        scores = matrix @ matrix[i]
        want = np.lexsort((ids, -scores))
        want = want[want % 2 == 1][:5]
        assert place.tolist() == want.tolist() and score.tolist() == scores[want].tolist()
        early += met < 2000
    assert early >= 8


def test_scores_beyond_doubles_are_exact():
    big = (1 << 31) + 1
    lists = negatives.Lists(np.arange(2), np.arange(2), np.zeros(2, int), np.array([[big, 1], [big, 0]]))
    assert lists._scores(np.arange(2), np.array([big, 1])).tolist() == [big * big + 1, big * big]
    with pytest.raises(OverflowError):
        negatives.Lists(np.arange(1), np.arange(1), np.zeros(1, int), np.array([[1 << 61]]))._scores(np.arange(1), np.array([1 << 61]))


def test_large_components_are_refused(spark):
    rows = [(0, [1e300], 1), (1, [1.0], 1)]
    with pytest.raises(Exception, match="too large"):
        negatives.mined(frame(spark, rows), F.col("label"), F.col("vec_id") == 0).collect()
