"""Text that one task takes apart does not grow with the table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from findlark import IndexSpec, Registry, Settings
from findlark.operators import changes
from findlark.operators import postings as P
from findlark.plans.store import IndexStore

TEXT = Registry([IndexSpec("Title", "text")])


@pytest.fixture
def rows(spark):
    texts = [(f"d{k}", f"word{k % 7} common word{k % 3} common") for k in range(200)] + [("d0", "common again"), (None, None)]
    return spark.createDataFrame(texts, "uid string, Title string")


def sorted_rows(df):
    return sorted(map(str, df.collect()))


def test_postings_are_dealt_by_text(rows, monkeypatch):
    few = P.build_postings(rows, ["Title"])
    expected = sorted_rows(few)
    monkeypatch.setattr(P, "TASK_BYTES", 500)
    assert P.tasks(rows, ["Title"]) > 10
    many = P.build_postings(rows, ["Title"])
    assert few.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() > 10
    assert sorted_rows(many) == expected


@pytest.mark.parametrize("overlay", [False, True])
def test_store_is_written_by_text(spark, rows, tmp_path, monkeypatch, overlay):
    tables = []
    for size in (1 << 22, 500):
        monkeypatch.setattr(P, "TASK_BYTES", size)
        store = IndexStore(spark, str(tmp_path / str(size)), TEXT, Settings(buckets=2, search_only=frozenset()))
        store.convert()
        unique = rows.where("uid is not null").dropDuplicates(["uid"])
        if overlay:
            store.commit(changes.full_indexes(unique))
        else:
            store.rebuild(unique)
        files = len(list((tmp_path / str(size)).rglob("postings/**/*.parquet")))
        text = store.index().text
        terms = text.term_stats.groupBy("field", "term").agg({"df": "sum"})
        tables.append((files, sorted_rows(text.docs.select("uid")), sorted_rows(terms), sorted_rows(text.field_stats.groupBy("field").sum("n", "words"))))
    (few, *one), (many, *other) = tables
    assert few <= 2 and many > 8 and one == other


def test_every_shard_has_a_task(spark, rows, tmp_path, monkeypatch):
    """Shards are not dealt by a hash, which puts several into one task and leaves others without."""
    monkeypatch.setattr(P, "TASK_BYTES", 500)
    store = IndexStore(spark, str(tmp_path), TEXT, Settings(buckets=2, search_only=frozenset()))
    dealt = rows.where("uid is not null").dropDuplicates(["uid"])
    store.rebuild(dealt)
    shards = -(-P.tasks(dealt, ["Title"]) // 2)
    assert shards > 4
    for table in ("docs", "postings"):
        for bucket in tmp_path.rglob(f"{table}/v=*/bucket=*"):
            assert len(list(bucket.glob("*.parquet"))) == shards


def test_word_counts_are_dealt_by_postings(spark, rows, tmp_path, monkeypatch):
    tables = []
    for size in (1 << 27, 400):
        monkeypatch.setattr("findlark.plans.store.COUNT_BYTES", size, raising=False)
        store = IndexStore(spark, str(tmp_path / str(size)), TEXT, Settings(buckets=2, search_only=frozenset()))
        store.rebuild(rows.where("uid is not null").dropDuplicates(["uid"]))
        files = len(list((tmp_path / str(size)).rglob("terms/**/*.parquet")))
        tables.append((files, sorted_rows(store.index().text.term_stats.drop("v"))))
    (few, one), (many, other) = tables
    assert few <= 2 < many and one == other


def test_postings_lie_in_order_of_runs(spark, tmp_path):
    texts = [(f"d{k:04}", "common " * (k % 9 + 1)) for k in range(700)]
    store = IndexStore(spark, str(tmp_path), TEXT, Settings(buckets=2, search_only=frozenset()))
    store.rebuild(spark.createDataFrame(texts, "uid string, Title string"))
    files = list(tmp_path.rglob("postings/**/*.parquet"))
    for file in files:
        runs = [row["run"] for row in spark.read.parquet(str(file)).coalesce(1).collect()]
        assert runs == sorted(runs) and runs[-1] >= 1
    assert len(files) == 2


def test_full_indexes_take_no_payload_into_the_join(spark):
    """The join is for partial updates; texts of documents indexed as a whole are not shuffled for it."""
    index = spark.createDataFrame([("a", "old"), ("b", "old"), ("c", "old")], "uid string, Title string")
    fresh = changes.full_indexes(spark.createDataFrame([("a", "new"), ("z", "new")], "uid string, Title string"))
    part = fresh.where("uid = 'z'").selectExpr("'b' as uid", "cast(null as string) as base", "attributes", "payload")
    after = changes.apply_changes(index, fresh.unionByName(part))
    assert sorted(map(tuple, after.collect())) == [("a", "new"), ("b", "new"), ("c", "old"), ("z", "new")]
    empty = spark.createDataFrame([], index.schema)
    plan = changes.apply_changes(empty.union(index.limit(0)), fresh)._jdf.queryExecution().analyzed().toString()
    assert "CASE WHEN isnull(base" in plan


@pytest.mark.parametrize("size", [1 << 22, 300])
def test_texts_are_inverted_in_tasks(spark, monkeypatch, size):
    """The same postings as those of words that are rows, in runs of the best, with nothing shuffled for them."""
    monkeypatch.setattr(P, "TASK_BYTES", size)
    texts = [("a", "Übergrößen ÜBER x_1 ½ über", "One two"), ("b", "plain Plain, text-42\u0000text", None), (None, "no id", "no")]
    texts += [("twice", "same words here", "x"), ("twice", "same words there", "x"), ("twice", "other", ""), ("c", "", " . "), ("d", "end", "end")]
    texts += [(f"d{k:04}", "common " * (k % 9 + 1) + f"w{k % 30}", "common") for k in range(400)]
    docs = spark.createDataFrame(texts, "uid string, Title string, Body string")
    odd = spark.range(1).selectExpr("'odd' AS uid", "cast(unhex('61FF62C3') AS string) AS Title", "cast(unhex('618062') AS string) AS Body")
    docs = docs.unionByName(odd).withColumn("bucket", F.lit(3))
    keys, fields = ("bucket", "uid"), ("Title", "Body")
    expected = P.build_postings(docs, fields, keys)
    found = P.inverted(docs.repartition(2, "uid"), fields, keys)
    assert found.where("run <> 0").count() == 0 and sorted_rows(found.drop("run")) == sorted_rows(expected)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    one = P.inverted(docs.coalesce(1), fields, keys, {"Title": 5.0, "Body": None})
    assert sorted_rows(one.drop("run")) == sorted_rows(expected)
    if size > 300:
        rows = one.where("field = 'Title' and term = 'common'").collect()
        assert [r["run"] for r in rows] == [0] * 64 + [1] * 192 + [2] * 144
        worth = [P.saturation(r["tf"], r["len"], 5.0) for r in rows]
        assert worth == sorted(worth, reverse=True)


def test_words_of_documents(spark):
    docs = spark.createDataFrame([("a", "b B a c", None), ("z", None, "x")], "uid string, Title string, Body string")
    found = [(r["uid"], r["words"].asDict(), r["terms"].asDict()) for r in P.with_words(docs, ["Title", "Body"]).collect()]
    assert found == [
        ("a", {"Title": 4, "Body": 0}, {"Title": ["a", "b", "c"], "Body": []}),
        ("z", {"Title": 0, "Body": 1}, {"Title": [], "Body": ["x"]}),
    ]
