"""Periodic runs of words against plain Python that tries every period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_rows import ODD

from findlark.llm import periods


def plain_runs(words, least=12):
    """``start, length, period`` of all runs, found period by period."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in out.items())


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def turned(doc_id, words):
    """The words of the contract's rewritten documents."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = turned(doc_id, split(text))
    found = plain_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (
        doc_id,
        len(found),
        *best,
        best[1] and 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def query(docs):
    return periods.digests(periods.periodic_runs(periods.rewritten(docs)))


def key(row):
    return tuple((v is None, v or 0) for v in row)


def test_query_small_documents(docs, texts):
    """All documents of the small table that plain Python can try in time, and every rewritten one."""
    picked = {
        i: t for i, t in texts.items() if len(split(t)) <= 400 or (zlib.crc32(str(i).encode()) % 10 == 0 and len(split(t)) < 2500)
    }
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in picked) > 5
    found = {r[0]: tuple(r) for r in query(docs).collect()}
    assert len(found) == len(texts)
    for i, t in picked.items():
        assert found[i] == expected(i, t)


def test_odd_rows(odd, empty):
    rows = [(i, t) for i, t in ODD if len(split(t)) < 1000]
    found = sorted((tuple(r) for r in query(odd).collect()), key=key)
    assert len(found) == len(ODD)
    left = list(found)
    for i, t in rows:
        left.remove(expected(i, t))
    assert query(empty).count() == 0
    assert periods.periodic_runs(odd).where("doc_id = 9").first()["n_words"] == len(split(dict(ODD)[9]))


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    for _ in range(150):
        docs = []
        for _ in range(rng.randint(1, 4)):
            n, k = rng.randint(0, 90), rng.choice([1, 2, 3, 5, 60])
            words = [rng.randrange(k) for _ in range(n)]
            if n > 14 and rng.random() < 0.6:
                a, share = rng.randrange(n), rng.randint(2, 9)
                p = 1 + (n - a) // share
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
                words[rng.randrange(n)] = rng.choice([99, words[0]])
            docs.append(words)
        counts = np.array([len(d) for d in docs])
        after = np.cumsum(counts)
        ids = np.array([w for d in docs for w in d], np.int64)
        found = periods.runs(ids, np.repeat(after - counts, counts), np.repeat(after, counts), 12)
        plain = [(s + o, s + o + n, q) for d, o in zip(docs, after - counts) for s, n, q in plain_runs(d)]
        assert sorted(map(tuple, found.tolist())) == sorted(plain)


def test_runs_stay_inside_of_documents(make):
    rows = [(1, "a b " * 5), (2, "a b " * 5), (3, "a b " * 6), (4, "x " * 11), (5, "x " * 12), (6, "q " + "x y z " * 4 + "x q")]
    found = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periods.periodic_runs(make(rows)).collect()}
    assert found == {1: [], 2: [], 3: [(0, 12, 2)], 4: [], 5: [(0, 12, 1)], 6: [(1, 13, 3)]}


def test_collapsed_text(make):
    text = "start " + "one two three four five six " * 3 + "end"
    row = periods.periodic_runs(make([(1, text)])).first()
    assert row["collapsed"] == "start one two three four five six end"


def test_very_long_periodic_text(make):
    """300,000 words of one period, and as many equal ones, in a document each."""
    one = " ".join(f"w{k % 4999}" for k in range(300_000))
    rows = periods.periodic_runs(make([(1, one), (2, "same " * 300_000)])).orderBy("doc_id").collect()
    assert [[tuple(x) for x in r["runs"]] for r in rows] == [[(0, 300_000, 4999)], [(0, 300_000, 1)]]
