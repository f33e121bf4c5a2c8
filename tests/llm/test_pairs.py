"""Operators on pairs against brute force: op1, op3, and the components below them."""

import math
import random
import re

import numpy as np
import pytest

from textmark.llm import jaccard, lattice
from textmark.llm.frames import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def labels(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(300, 300), (7, 3), (3, 7)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    found = {x["node"]: x["root"] for x in components(df).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{x: 100 for x in range(100, 160)}}
    assert components(df.limit(0)).count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute_jaccard(rows):
    sets = [shingles(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and None not in (rows[i][0], rows[j][0])
        and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    root = labels(len(rows), links)
    least = {}
    for (key, _), r in zip(rows, root, strict=True):
        if key is not None:
            least[r] = min(key, least.get(r, key))
    return sorted(((k, len(s), least[r] if k is not None else None) for (k, _), s, r in zip(rows, sets, root, strict=True)), key=repr)


def near_copies(seed, groups=6, each=45, size=40):
    """Groups that hold links, chains of links and pairs just below the bound."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{g}x{rng.randint(0, 400)}" for _ in range(rng.choice([4, 9, size, 3 * size]))]
        for _ in range(each):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                words[rng.randrange(len(words))] = f"n{rng.randint(0, 10**6)}"
            rows.append(" ".join(words + ["common"] * rng.choice([0, 0, 7])))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [16, 2048])
def test_jaccard_loses_no_link(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard, "COMPARED", 8)
    if block == 16:  # every shared shingle counts as frequent
        monkeypatch.setattr(jaccard, "SPARSE", 1)
        monkeypatch.setattr(jaccard, "FREQUENT", 2)
    rows = near_copies(block)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = jaccard.near_duplicates(df, block=block).collect()
    assert sorted((tuple(x) for x in found), key=repr) == brute_jaccard(rows)


def test_jaccard_null_key_before_its_copies(spark):
    """The first copies of a text in the only split have no key; those behind them still link."""
    base = [f"w{i}" for i in range(60)]
    near = [" ".join([*base[:i], f"n{i}", *base[i + 1 :]]) for i in (0, 59)]
    rows = [(None, " ".join(base)), (None, near[0]), (5, " ".join(base)), (9, near[0]), (7, " ".join(base)), (None, near[1]), (11, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = sorted((tuple(x) for x in jaccard.near_duplicates(df).collect()), key=repr)
    assert found == brute_jaccard(rows)
    assert {x[0]: x[2] for x in found if x[0] is not None} == {5: 5, 7: 5, 9: 5, 11: 11}


def test_jaccard_edges(spark, edges, nothing):
    from conftest import TEXTS

    found = jaccard.near_duplicates(edges)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(x) for x in found.collect()), key=repr) == brute_jaccard(TEXTS)
    assert jaccard.near_duplicates(nothing).collect() == []
    with pytest.raises(ValueError):
        jaccard.near_duplicates(edges, percent=40)


def test_tree_walk_finds_every_possible_pair():
    rng = np.random.default_rng(3)
    words = jaccard.bits_of(6) // 64
    maps = rng.integers(0, 1 << 63, (700, words), np.uint64) & rng.integers(0, 1 << 63, (700, words), np.uint64)
    maps[350:] = maps[:350]
    extra = rng.integers(0, 3, 700)
    n = jaccard._popcount(maps) + extra
    tree = jaccard.Tree(maps, n, n + rng.integers(0, 9, 700), extra)
    pairs = {(x, y) for a, b in jaccard.walk(tree, tree, True, 75, lambda a, b: a >= 0) for x, y in zip(a.tolist(), b.tolist(), strict=True)}
    a, b = np.triu_indices(700, 1)
    keep = jaccard._possible(tree, tree, 0, 0, a, b, 75)
    assert pairs == set(zip(a[keep].tolist(), b[keep].tolist(), strict=True))


def brute_cosine(rows, bound=0.9):
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = []
    for i, (_, v) in enumerate(rows):
        for j in range(i):
            u = rows[j][1]
            if good(v) and good(u) and len(v) == len(u):
                a, b = np.array(v, float), np.array(u, float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= bound:
                    links.append((i, j))
    root, least, count = labels(len(rows), links), {}, [0] * len(rows)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    for (key, _), r in zip(rows, root, strict=True):
        if key is not None:
            least[r] = min(key, least.get(r, key))
    return sorted(((k, c, least.get(r), k is not None and k == least.get(r)) for (k, _), c, r in zip(rows, count, root, strict=True)), key=repr)


def test_lattice_edges_and_copies(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, None), (2, []), (3, [0.0] * 16), (4, [1.0, None] + [0.0] * 14), (5, [nan] + [1.0] * 15), (6, [inf] + [1.0] * 15),
        (7, [1.0] * 16), (8, [2.0] * 16), (8, [2.0] * 16), (None, [3.0] * 16), (9, [-1.0] * 16), (10, [1.0] * 8),
        (11, [1e30] * 16), (12, [1e-30] * 16), (None, None), (13, [1.0] * 3), (14, [1.0, 1.0, 1.05]),
    ]
    schema = "vec_id long, embedding array<float>, node long, cell long, root long, size long"
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], schema).repartition(4)
    found = sorted((tuple(x) for x in lattice.near_duplicates(df).collect()), key=repr)
    assert found == brute_cosine(rows)
    doubles = df.selectExpr("vec_id", "cast(embedding as array<double>) as embedding")
    assert sorted((tuple(x) for x in lattice.near_duplicates(doubles).collect()), key=repr) == brute_cosine(rows)
    assert lattice.near_duplicates(df.limit(0)).collect() == []


def test_lattice_large_group_in_blocks(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal(64)
    rows = [(i, (base + 0.12 * rng.standard_normal(64)).astype("f4").tolist()) for i in range(150)]
    rows += [(1000 + i, rng.standard_normal(64).astype("f4").tolist()) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted((tuple(x) for x in lattice.near_duplicates(df, block=16).collect()), key=repr)
    assert found == brute_cosine(rows)


def test_nearest_lattice_point_by_trial():
    rng = np.random.default_rng(1)
    x = 2 * rng.standard_normal((300, 8))
    points = lattice.decoded(x)
    assert ((points * 2) % 1 == 0).all() and (points.sum(1) % 2 == 0).all()
    best = ((x - points) ** 2).sum(1)
    for step in lattice._NEIGHBOURS:  # no neighbour lies closer
        assert (best <= ((x - points - step) ** 2).sum(1) + 1e-9).all()
    assert len(lattice._NEIGHBOURS) == 240


@pytest.mark.parametrize(("cosine", "least"), [(0.9, 0.95), (0.92, 0.98), (0.95, 0.995)])
def test_recall_of_the_cells(cosine, least):
    rng = np.random.default_rng(17)
    x = lattice._unit(rng.standard_normal((3000, 64)))
    z = rng.standard_normal(x.shape)
    z = lattice._unit(z - (z * x).sum(1, keepdims=True) * x)
    shape = (3000, lattice.TABLES, lattice.PROBES + 1)
    args = (lattice.TABLES, lattice.PROBES, lattice.SCALE, lattice.SEED)
    a = lattice.cells(x, *args).reshape(shape)
    b = lattice.cells(cosine * x + np.sqrt(1 - cosine**2) * z, *args).reshape(shape)
    met = (a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)
    assert met.any(1).mean() >= least
