"""The pruned first page against the ranking of all hits."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from findlark import IndexSpec, Registry, Settings
from findlark.operators import changes, firstpage
from findlark.operators import postings as P
from findlark.operators.firstpage import FirstPage
from findlark.plans.store import IndexStore
from findlark.streaming.feed import commit_batch

TEXT = Registry([IndexSpec("SearchableText", "text"), IndexSpec("Title", "text"), IndexSpec("kind", "field", analyzed=False)])
ROWS = "uid string, SearchableText string, Title string, kind string"
FEED = "uid string, seq long, op string, attributes array<string>, payload struct<SearchableText:string,Title:string,kind:string>"
WORDS = [f"w{k}" for k in range(40)]


def library(seed, count):
    """Texts of common and rare words, many of them equal, so that scores tie."""
    rng = random.Random(seed)
    rows = []
    for n in range(count):
        size = rng.choice([3, 8, 8, 8, 30, 120])
        words = rng.choices(WORDS, [1 / (k + 1) for k in range(40)], k=size)
        if n % 7 == 0:
            words = ["w0", "w1", "w2"] * (size // 3)
        rows.append((f"u{n:05d}", " ".join(words), " ".join(words[:3]) if n % 3 else None, f"k{n % 4}"))
    return rows


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = IndexStore(spark, str(tmp_path_factory.mktemp("index")), TEXT, Settings(buckets=3, search_only=frozenset(), retries=0))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(P, "RUN", 4)
        store.rebuild(spark.createDataFrame(library(1, 1500), ROWS))
    return store


def compared(found, start, size):
    whole = [(r["uid"], r["score"]) for r in found.hits.select("uid", "score").collect()]
    whole = sorted(whole, key=lambda r: (-r[1], r[0]))[start : start + size]
    page = [(r["uid"], r["score"]) for r in found.page(start, size).select("uid", "score").collect()]
    assert page == whole
    return page


@pytest.mark.parametrize(
    "query",
    [
        {"SearchableText": "w0 w1 w2"}, {"SearchableText": "w39"}, {"SearchableText": "w0"}, {"Title": "w0 w1"},
        {"Title": "w3"}, {"SearchableText": "w5 w3 w3"}, {"SearchableText": "w0 w1", "kind": "k2"},
        {"SearchableText": "w0 w1", "Title": "w2"}, {"SearchableText": "nowhere w30"}, {"SearchableText": "nowhere"},
    ],
)
def test_same_rows_as_all_hits(store, query):
    found = store.index().search(query)
    for start, size in ((0, 20), (13, 3)):
        compared(found, start, size)


def test_fewer_postings_are_read(store):
    index = store.index()
    plan = index.search({"SearchableText": "w0 w1 w2"}).plan
    first = FirstPage(index.text, plan.clauses, plan.where, 5)
    rows = first.rows()
    assert rows is not None and first.read < first.total / 2 and first.scored < 500
    scan = first._read(first.depths)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in scan and "LessThanOrEqual(run," in scan
    assert "positions" not in scan.split("ReadSchema", 1)[1].split("\n")[0]


def test_many_equal_scores(spark, tmp_path, monkeypatch):
    """All hits tie: the bound excludes none of them, and the smallest ids come first."""
    monkeypatch.setattr(firstpage, "MOST_NAMED", 50)
    store = IndexStore(spark, str(tmp_path), TEXT, Settings(buckets=2, search_only=frozenset(), retries=0))
    store.rebuild(spark.createDataFrame([(f"u{n:04d}", "same words", None, "k") for n in range(400)], ROWS))
    page = compared(store.index().search({"SearchableText": "words"}), 0, 10)
    assert [uid for uid, _ in page] == [f"u{n:04d}" for n in range(10)]


def test_after_commits(spark, store):
    """Replaced and deleted documents, and new ones that score best, in overlays."""
    feed = [
        ("u00007", 1, "reindex", ["SearchableText"], ("w0 w0 w1", None, None)),
        ("u00014", 1, "unindex", [], None),
        ("new", 1, "index", [], ("w0 w1 w2 w0 w1 w2", "w0 w1 w2", "k2")),
        ("u00021", 1, "index", [], ("nothing of it", None, "k2")),
    ]
    commit_batch(store, spark.createDataFrame(feed, FEED), 1)
    for query in ({"SearchableText": "w0 w1 w2"}, {"SearchableText": "w0 w1 w2", "kind": "k2"}, {"Title": "w0 w1 w2"}):
        page = compared(store.index().search(query), 0, 20)
        assert "u00014" not in dict(page) and "u00021" not in dict(page)
    assert "new" in dict(compared(store.index().search({"Title": "w0 w1 w2", "kind": "k2"}), 0, 20))


def test_bounds_hold_for_every_posting(store):
    """No posting is worth more than what its run's row of the word table allows."""
    text = store.index().text
    worth = P.saturation(F.col("tf"), F.col("len"), 9.5)
    own = text.postings.groupBy("bucket", "field", "term", "run").agg(F.max(worth).alias("own"), F.count("*").alias("n"))
    told = text.term_stats.where("bucket >= 0").groupBy("bucket", "field", "term", "run")
    told = told.agg(F.max(worth).alias("told"), F.sum("df").alias("df"))
    joined = own.where("bucket >= 0").join(told, ["bucket", "field", "term", "run"], "full")
    assert joined.where("own is null or told is null or own > told or n <> df").isEmpty()


# --- commits leave old texts alone ---


def test_replacing_and_deleting_reads_no_text(spark, tmp_path, monkeypatch):
    store = IndexStore(spark, str(tmp_path), TEXT, Settings(buckets=2, search_only=frozenset(), retries=0))
    store.rebuild(spark.createDataFrame(library(3, 60), ROWS))
    pending = changes.compact(
        spark.createDataFrame(
            [("u00001", 1, "index", [], ("w0 new", "t", "k")), ("u00002", 1, "unindex", [], None), ("x", 1, "index", [], ("w1", None, "k"))],
            FEED,
        ),
        store.attributes,
    )
    plan = store._replaced(pending, [0, 1], store.current())._jdf.queryExecution().executedPlan().toString()
    # the first scan is that of the stored documents
    read = plan.split("FileScan parquet ")[1].split("]")[0]
    assert "uid" in read and "terms" in read and "words" in read and "SearchableText#" not in read and "Title#" not in read

    def whole_rows(*_, **__):
        raise AssertionError("whole rows were read")

    monkeypatch.setattr(IndexStore, "rows_of", whole_rows)
    done = store.commit(pending)
    assert (done.indexed, done.deleted) == (2, 1)
    fresh = IndexStore(spark, str(tmp_path / "fresh"), TEXT, Settings(buckets=2, search_only=frozenset(), retries=0))
    fresh.rebuild(store.rows())
    for query in ({"SearchableText": "w0 w1"}, {"Title": "w0"}):
        found = [
            {r["uid"]: round(r["score"], 9) for r in s.index().search(query).hits.select("uid", "score").collect()} for s in (store, fresh)
        ]
        assert found[0] == found[1] and found[0]
