"""The prefix trie of conversations against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from findlark.llm import prefixes

TURNS = "conv_id long, turn long, role string, text string, depth int, last string, _part int"


def ordered(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(np.fix(c / 100)) * 100
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    below = {}
    for node in sorted(members, key=len, reverse=True):
        spared = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        leaves = 0 if kids[node] else 1
        for kid in kids[node]:
            leaves, spared = leaves + below[kid][0], spared + below[kid][1]
        below[node] = leaves, spared
    out = []
    for node, own in members.items():
        ends = sorted(c for c in own if len(convs[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), parent, len(own), len(kids[node]), *below[node], digest))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 5, "x", None) for r in rows], TURNS)


def found(trie):
    return sorted(map(tuple, trie.collect()), key=str)


def families(seed, count, depth, copies=0):
    """Conversations with common beginnings; ``copies`` of one, all under one first turn."""
    rng = random.Random(seed)
    rows = []
    for c in range(count):
        first = 0 if c % 3 else rng.randrange(5)
        for turn in range(rng.randint(1, depth)):
            text = f"t{first if turn == 0 else rng.randrange(3)}" * rng.randint(1, 2)
            rows.append((c * 7 - 20, turn, rng.choice(["user", "assistant"]) if turn else "user", text))
    for c in range(copies):
        rows += [(10_000 + c, turn, "user", f"copy {turn}") for turn in range(3)]
    return rows


def test_query_small_table(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert found(prefixes.rebuilt_trie(turns)) == plain_trie(rebuilt(ordered(rows)))


@pytest.mark.parametrize("gather", [1 << 16, 40])
def test_families_and_copies(spark, monkeypatch, gather):
    """Also with components too large for a task, which joins take apart first."""
    monkeypatch.setattr(prefixes, "GATHER", gather)
    rows = families(3, 120, 6, copies=60)
    turns = prefixes.signatures(table(spark, rows))
    assert found(prefixes.prefix_trie(turns)) == plain_trie(ordered(rows))


def test_long_conversation(spark, monkeypatch):
    """One conversation of many turns over several tasks, and others that leave it."""
    monkeypatch.setattr(prefixes, "GATHER", 150)
    long = [(5, k, "user", f"turn {k % 17}") for k in range(500)]
    rows = long + [(6, k, "user", f"turn {k % 17}" if k < 230 else "else") for k in range(300)] + [(7, 0, "user", "turn 0")]
    turns = prefixes.signatures(table(spark, rows))
    assert found(prefixes.prefix_trie(turns)) == plain_trie(ordered(rows))


def test_odd_turns(spark):
    """Nulls in every column, ties, rows repeated in full, empty and very long texts, clashing columns."""
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, "", ""), (1, 1, "user", "x" * 100_000),
        (2, 0, "user", "é😀"), (2, 0, "user", "é😀"), (2, 0, "assistant", "é😀"), (None, 0, "user", "lost"),
        (None, None, None, None), (-150, 0, "user", "first"), (-100, 3, "user", "base"), (-100, 1, "user", "base"),
        (300, 0, "a", "bc"), (301, 0, "ab", "c"),
    ]
    data = table(spark, rows)
    assert found(prefixes.prefix_trie(prefixes.signatures(data))) == plain_trie(ordered(rows))
    assert found(prefixes.rebuilt_trie(data)) == plain_trie(rebuilt(ordered(rows)))


def test_empty_table(spark):
    assert prefixes.rebuilt_trie(table(spark, [])).count() == 0
    assert prefixes.prefix_trie(prefixes.signatures(table(spark, []))).count() == 0


def test_ids_in_pieces(spark, monkeypatch):
    """Many ids that end at one node, hashed piece by piece."""
    monkeypatch.setattr(prefixes, "CHUNK", 200)
    rows = [(c, 0, "user", "hello") for c in range(3000)]
    assert found(prefixes.rebuilt_trie(table(spark, rows))) == plain_trie(rebuilt(ordered(rows)))


def test_decomposition_of_random_forests():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 60)
        parent, depth = [-1], [0]
        for k in range(1, n):
            over = rng.choice([-1, 0, k - 1, rng.randrange(k)])
            parent.append(over)
            depth.append(depth[over] + 1 if over >= 0 else 0)
        values = np.array([[rng.randint(-5, 9), 1] for _ in range(n)])
        sums = values.copy()
        for k in range(n - 1, -1, -1):
            if parent[k] >= 0:
                sums[parent[k]] += sums[k]
        assert np.array_equal(prefixes.decompose(np.array(parent), np.array(depth), values), sums)
