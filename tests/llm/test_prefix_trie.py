"""The trie of conversations beside a plain one, with few and with very many splitters."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from textmark.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, node long, shard long, path string, pos int, ends string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [x[2:] for x in sorted(turns)] for conv, turns in by.items()}


def rebuilt(rows):
    own = ordered(rows)
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - conv % 100 if conv >= 0 else conv + -conv % 100
        out[conv] = own.get(base, [])[:h] + turns[h:]
    return out


def plain(conversations):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(conv)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(of) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            (min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children[node]), leaves[node],
             saved[node], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
            for node, of in members.items()
        ),
        key=repr,
    )


def conversations(seed, n=260, turns=7, words=3):
    """Shared beginnings, many copies of one conversation, turnless ones, nulls, ties and repeats."""
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        same = conv % 3 == 0
        for turn in range(5 if same else rng.randint(1, turns)):
            text = f"the same {turn}" if same else "żó" * rng.randint(0, 3) + f"{rng.randint(0, words)}"
            rows.append((conv + 100, turn, "user" if turn % 2 == 0 else "assistant", text))
    rows += [(-7, 1, None, None), (-7, None, "user", "first"), (-7, 2, "x", ""), (-100, 0, "user", "base"), (-100, 1, "user", "b")]
    rows += [(None, 0, "user", "lost"), (9001, 3, "user", "b"), (9001, 3, "user", "a"), (9002, 3, "user", "a"), (9002, 3, "user", "a")]
    rows += [(10**12, t, "user", "long " * 5000 if t == 1 else str(t)) for t in range(300)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, 1, 2, "p", 3, "e") for x in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize(("seed", "shard_turns"), [(1, 3), (2, 40), (3, 10**6)])
def test_every_node_of_the_plain_trie(spark, monkeypatch, seed, shard_turns):
    monkeypatch.setattr(prefix_trie, "TEXT_BYTES", 16)
    rows = conversations(seed)
    of = prefix_trie.paths(prefix_trie.turns(frame(spark, rows)))
    found = prefix_trie.trie(of, shard_turns)
    assert found.columns == NAMES
    assert sorted((tuple(x) for x in found.collect()), key=repr) == plain(ordered(rows))


def test_query_and_edges(spark, tables):
    rows = conversations(4)
    found = queries.op11_prefix_trie(spark, tables(conversations=frame(spark, rows)))
    assert sorted((tuple(x) for x in found.collect()), key=repr) == plain(rebuilt(rows))
    assert queries.op11_prefix_trie(spark, tables(conversations=frame(spark, rows).limit(0))).count() == 0
    lost = frame(spark, rows).where("conv_id is null")
    assert queries.op11_prefix_trie(spark, tables(conversations=lost)).count() == 0


def test_nodes_across_shards_stand_in_the_skeleton(spark):
    rows = conversations(5)
    of = prefix_trie.paths(prefix_trie.turns(frame(spark, rows))).cache()
    bones = prefix_trie.skeleton(of, 20)
    assert len(bones.splitters) > 20
    shards = defaultdict(set)
    copies = set()
    for row in of.collect():
        path = bytes(row["path"])
        shard = bones.shard(path, row["conv"])
        copies.add(shard) if len(row["lengths"]) == 5 and row["conv"] % 3 == 1 else None
        for at in range(0, len(path) + 1, prefix_trie.STEP):
            shards[path[:at]].add(shard)
    known = {b""} | {p[:at] for p, _ in bones.splitters for at in range(0, len(p) + 1, prefix_trie.STEP)}
    assert {x for x, of in shards.items() if len(of) > 1} <= known
    assert len(copies) > 3  # one path, cut by conversation
    small = prefix_trie.skeleton(of, 20, most=2000)
    assert 0 < len(small.splitters) < len(bones.splitters)
    assert prefix_trie.skeleton(of.where(F.lit(False))).splitters == []
    of.unpersist()
