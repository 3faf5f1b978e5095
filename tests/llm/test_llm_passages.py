from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa

from findlark.llm import passages


def brute_part(a, at_a, b, at_b, width, similarity):
    """The part two contents are similar in, run by run."""
    before, after = min(at_a, at_b), min(len(a) - at_a, len(b) - at_b) - 1
    if before + after + 1 < width:
        return None
    x, y = a[at_a - before : at_a + after + 1], b[at_b - before : at_b + after + 1]
    share = lambda p, q: len({*p} & {*q}) / len({*p} | {*q})
    if share(x, y) >= similarity:
        return before, after
    shares = [share(x[k : k + width], y[k : k + width]) for k in range(len(x) - width + 1)]
    best = shares.index(max(shares))
    return (before - best, best + width - 1 - before) if shares[best] >= similarity else None


def made(rng, width, few):
    """Contents around one minimum: near copies of each other, shifted, cut, some of few shingles."""
    base = [rng.randrange(3) if few else rng.randrange(1 << 32) for _ in range(2 * width - 1)]
    rows = []
    for _ in range(24):
        body = [rng.randrange(1 << 32) if rng.random() < 0.06 else s for s in base]
        if rng.random() < 0.5:
            place = rng.randrange(width - 1)
            body = body[1 : place + 1] + [rng.randrange(1 << 32)] + body[place + 1 :]
        body[width - 1] = 7
        left, right = rng.randrange(width), rng.randrange(width)
        if left + right + 1 < width:
            left = width - 1
        rows.append((body[width - 1 - left : width + right], left))
    return rows


def laid(rows, width):
    return passages.Contents([np.array(b, np.uint32).tobytes() for b, _ in rows], np.array([at for _, at in rows]), width)


def test_parts_are_those_of_every_run():
    rng, width = random.Random(5), 12
    found = 0
    for n in range(60):
        rows = made(rng, width, n % 3 == 0)
        pairs = [(j, k) for k in range(len(rows)) for j in range(k)]
        before, after = laid(rows, width).parts(*np.array(pairs).T, 0.8)
        for (j, k), b, a in zip(pairs, before.tolist(), after.tolist()):
            expected = brute_part(*rows[j], *rows[k], width, 0.8)
            assert ((b, a) if b >= 0 else None) == expected
            found += expected is not None
    assert 1000 < found < 15_000


def test_contents_of_few_shingles_are_not_compared_in_pairs():
    """Contents that repeat some shingles and share one of them cannot be similar."""
    rows = [([10 * n + k % 6 + 100 for k in range(20)] + [7] + [10 * n + 105] * 25, 20) for n in range(400)]
    asked, contents = 0, laid(rows, 46)
    group = passages.matches(contents, 0, len(rows), np.zeros(len(rows), int), 0.8)
    try:
        some, _ = next(group)
        while True:
            asked += len(some)
            some, _ = group.send([None] * len(some))
    except StopIteration as over:
        assert over.value == []
    assert asked == 0


def test_contents_laid_out_together_stay_small(monkeypatch):
    """Several tables of the size of the layout are held at once, and an executor has several workers."""
    width, values = 46, 8000
    draw = np.random.default_rng(5)
    bodies = draw.integers(1, 1 << 32, (values, width), np.uint32)
    near = bodies.copy()
    near[:, 0] ^= np.uint32(1)
    both = np.stack([bodies, near], axis=1).reshape(-1, width)
    value = np.repeat(np.arange(values), 2)
    columns = {
        "value": value, "one": np.zeros_like(value), "two": np.zeros_like(value), "own": np.zeros_like(value),
        "content": np.arange(len(value)), "body": [b.tobytes() for b in both], "at": np.full(len(value), 20, np.int32),
    }
    rows = pa.table(columns).to_batches(max_chunksize=1000)
    cells, plain = [], passages.Contents

    class Noted(plain):
        def __init__(self, *given):
            super().__init__(*given)
            cells.append(self.grid.size)

    monkeypatch.setattr(passages, "Contents", Noted)
    found = pa.Table.from_batches(passages.compared(iter(rows), width, 0.8))
    assert max(cells) <= 1 << 21
    monkeypatch.setattr(passages, "GRID_CELLS", 1 << 30)
    at_once = pa.Table.from_batches(passages.compared(iter(rows), width, 0.8))
    assert found.num_rows == values and found.to_pydict() == at_once.to_pydict()


def test_merged_ranges(spark):
    rng = random.Random(11)
    rows = [(doc, s, s + rng.randrange(1, 9)) for doc in (None, 1, 2, 7) for s in (rng.randrange(400) for _ in range(90))]
    rows += [(5, k, k + 2) for k in range(3000)] + [(6, 3, 4), (6, 3, 9), (6, 9, 10), (6, 11, 12)]
    rows = [(-1 if doc is None else doc, s, e) for doc, s, e in rows]
    expected = {}
    for doc, s, e in sorted(rows):
        ranges = expected.setdefault(doc, [])
        if ranges and ranges[-1][1] >= s:
            ranges[-1] = (ranges[-1][0], max(ranges[-1][1], e))
        else:
            ranges.append((s, e))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        # documents end inside of batches, at their ends, and go on over several
        for size in ("7", "90", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            found = passages.merged(spark.createDataFrame(rows, "doc_id long, start int, end int").coalesce(1)).collect()
            assert {r.doc_id: [tuple(s) for s in r.spans] for r in found} == expected and len(found) == len(expected)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert passages.merged(spark.createDataFrame([], "doc_id long, start int, end int")).collect() == []


def test_tables_are_removed_once_read(spark, monkeypatch):
    """The windows' values and shingles are not on disk any more while links and spans are worked out."""
    written, plain = {}, passages.materialise

    def noted(df, tag, *given):
        df = plain(df, tag, *given)
        written.setdefault(tag, []).extend(df.inputFiles())
        return df

    monkeypatch.setattr(passages, "materialise", noted)
    draw = random.Random(3)
    words = [f"w{draw.randrange(10**6)}" for _ in range(150)]
    rows = [(k, " ".join([*words[:75], f"x{k}", *words[75:]])) for k in range(12)]
    found = passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    there = {tag: [os.path.exists(f.removeprefix("file://")) for f in files] for tag, files in written.items()}
    assert there["values"] and not any(there["values"]) and there["window-shingles"] and not any(there["window-shingles"])
    assert all(there["windows"]) and {r.class_id for r in found.collect()} == {0}


def test_words_are_hashed_as_one_by_one():
    import xxhash

    rng = random.Random(2)
    texts = [b"", b" \t", "Ünïcode  GRÜN x y".encode(), b"\xff\xfe a\x1cb\x85c\x0bd\x0ce\rf\ng"]
    texts += [b" ".join(bytes(rng.randrange(33, 256) for _ in range(size)) for size in rng.sample(range(1, 80), 60)) for _ in range(5)]
    hashed, counts = passages.shingles(texts, 1)
    words = [t.lower().split() for t in texts]
    assert counts.tolist() == [len(w) for w in words]
    each = np.array([xxhash.xxh64_intdigest(w) for found in words for w in found], np.uint64)
    assert (hashed == passages.mixed(each)).all()
    assert [len(x) for x in passages.shingles([], 5)] == [0, 0]


def test_documents_are_cut_into_windows_once(spark, monkeypatch):
    calls, plain = [], passages.emitted
    monkeypatch.setattr(passages, "emitted", lambda *given: calls.append(given) or plain(*given))
    words = [f"w{k}" for k in range(80)]
    rows = [(1, " ".join(words)), (2, " ".join(["x", *words])), (3, "short")]
    found = passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(calls) == 1 and {r.doc_id: r.class_id for r in found} == {1: 1, 2: 1, 3: 3}


def test_groups_of_several_layouts_are_those_of_one(monkeypatch):
    """Groups are compared together whatever layout they come from, blocks that meet included."""
    rng, width, rows = random.Random(9), 12, []
    for value in range(30):
        across = value % 3 == 0
        for n, (body, at) in enumerate(made(rng, width, value % 5 == 0)):
            # some blocks meet none
            own = int(n < 9) if across and value % 2 else 0
            rows.append((value, 0, int(across), own, 100 * value + n, np.array(body, np.uint32).tobytes(), at))
    names = ["value", "one", "two", "own", "content", "body", "at"]
    table = pa.table([pa.array(c, pa.int32() if n == "at" else None) for c, n in zip(zip(*rows), names)], names)
    calls, plain = [0], passages.Contents.parts

    def parts(self, *given):
        calls[0] += 1
        return plain(self, *given)

    monkeypatch.setattr(passages.Contents, "parts", parts)
    found = []
    for cells in (1 << 19, 24 * 2 * width):
        monkeypatch.setattr(passages, "GRID_CELLS", cells)
        calls[0] = 0
        out = pa.Table.from_batches(passages.compared(iter(table.to_batches(max_chunksize=24)), width, 0.8))
        found.append((calls[0], out.sort_by([(c, "ascending") for c in out.column_names]).to_pydict()))
    assert found[0] == found[1] and len(found[0][1]["a"]) > 200
    assert all(a // 100 == b // 100 for a, b in zip(found[0][1]["a"], found[0][1]["b"]))
    assert not {*found[0][1]["value"]} & {v for v in range(0, 30, 3) if v % 2 == 0}
