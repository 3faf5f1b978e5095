"""Compaction and application of change feeds, against a plain model."""

from __future__ import annotations

import itertools
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from findlark import IndexSpec, Registry, Settings
from findlark.operators import changes
from findlark.plans import jobs
from findlark.plans.store import IndexStore
from findlark.streaming.feed import commit_batch, commit_files, drain, follow_feed, with_retries

FEED = "uid string, seq long, op string, attributes array<string>, payload struct<a:string,b:string>"
OPS = ("full", "a", "b", "delete")


def feed_row(uid, seq, kind):
    if kind == "delete":
        return (uid, seq, "unindex", [], None)
    if kind == "full":
        return (uid, seq, "index", [], (f"fa{seq}", f"fb{seq}"))
    return (uid, seq, "reindex", [kind], (f"pa{seq}", None) if kind == "a" else (None, f"pb{seq}"))


def model(sequence, partial):
    """One uid's pending state, change by change."""
    index, part, delete = None, None, False
    for seq, kind in enumerate(sequence):
        if kind == "full":
            index, part, delete = {"a": f"fa{seq}", "b": f"fb{seq}"}, None, False
        elif kind == "delete":
            index, part, delete = None, None, True
        elif index is not None:
            index[kind] = f"p{kind}{seq}"
        else:
            kept = part if part and partial == "merge" else {}
            part = {**kept, kind: f"p{kind}{seq}"}
    base = "index" if index is not None else "delete" if delete else None
    return base, index if index is not None else part or {}


@pytest.mark.parametrize("partial", ["merge", "replace"])
def test_compaction_equals_model(spark, partial):
    sequences = [s for n in range(1, 5) for s in itertools.product(OPS, repeat=n)]
    rows = [
        feed_row(f"u{i}", seq, kind) for i, s in enumerate(sequences) for seq, kind in enumerate(s)
    ]
    feed = spark.createDataFrame(rows, FEED).orderBy(F.rand(3)).repartition(7)
    got = {r["uid"]: r for r in changes.compact(feed, ["a", "b"], partial).collect()}
    assert len(got) == len(sequences)
    for i, sequence in enumerate(sequences):
        base, values = model(sequence, partial)
        row = got[f"u{i}"]
        payload = {k: v for k, v in row["payload"].asDict().items() if v is not None}
        assert (row["base"], payload) == (base, values), sequence
        assert sorted(row["attributes"]) == sorted(values)


def test_naming_every_attribute_is_a_full_index(spark):
    feed = spark.createDataFrame(
        [("u", 1, "unindex", [], None), ("u", 2, "reindex", ["b", "a"], ("x", None))], FEED
    )
    row = changes.compact(feed, ["a", "b"]).first()
    assert (row["base"], row["payload"].asDict()) == ("index", {"a": "x", "b": None})


def test_one_hot_uid_is_combined_before_the_shuffle(spark):
    feed = spark.range(20_000).select(
        F.lit("hot").alias("uid"),
        F.col("id").alias("seq"),
        F.lit("reindex").alias("op"),
        F.array(F.when(F.col("id") % 2 == 0, "a").otherwise("b")).alias("attributes"),
        F.struct(F.col("id").cast("string").alias("a"), F.col("id").cast("string").alias("b")).alias("payload"),
    )
    row = changes.compact(feed, ["a", "b"]).first()
    assert row["payload"].asDict() == {"a": "19998", "b": "19999"}
    plan = changes.compact(feed, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    # sequence numbers are combined before they are shuffled; payloads meet in a join by uid and number
    assert "partial_max_by" in plan and "SortAggregate" not in plan
    combined = [line for line in plan.splitlines() if "Aggregate" in line and "max" in line]
    assert combined and not any("payload" in line for line in combined)


def test_losing_payloads_are_not_carried(spark):
    """Many changes of one uid with long payloads: what is aggregated and joined has none that lost."""
    feed = spark.range(5_000).select(
        (F.col("id") % 3).cast("string").alias("uid"), F.col("id").alias("seq"), F.lit("reindex").alias("op"),
        F.array(F.when(F.col("id") % 2 == 0, "a").otherwise("b")).alias("attributes"),
        F.struct(F.repeat(F.lit("x"), 1000).alias("a"), F.concat(F.lit("b"), F.col("id").cast("string")).alias("b")).alias("payload"),
    )
    rows = {r["uid"]: r["payload"] for r in changes.compact(feed, ["a", "b"]).collect()}
    last = {str(u): max(k for k in range(5000) if k % 3 == u and k % 2) for u in range(3)}
    assert {u: (p["a"], p["b"]) for u, p in rows.items()} == {u: ("x" * 1000, f"b{k}") for u, k in last.items()}


ROWS = "uid string, a string, b string"


def test_stages_and_explicit_null(spark):
    base = spark.createDataFrame([("1", "x", "y"), ("2", "x", "y"), ("3", "x", "y")], ROWS)
    feed = spark.createDataFrame(
        [
            ("1", 1, "reindex", ["a"], (None, None)),
            ("2", 1, "unindex", [], None),
            ("2", 2, "reindex", ["a"], ("late", None)),
            ("3", 1, "index", [], ("new", None)),
            ("4", 1, "index", [], ("p", "q")),
            ("5", 1, "reindex", ["b"], (None, "lost")),
            ("6", 1, "unindex", [], None),
        ],
        FEED,
    )
    pending = changes.compact(feed, ["a", "b"])
    rows = sorted(tuple(r) for r in changes.apply_changes(base, pending).collect())
    assert rows == [("1", None, "y"), ("3", "new", None), ("4", "p", "q")]
    assert [r["uid"] for r in changes.rejected(base, pending).collect()] == ["5"]
    assert changes.pending_counts(pending).first().asDict() == {
        "n_index": 2,
        "n_update": 3,
        "n_delete": 2,
        "n_pending": 7,
    }


REGISTRY = Registry([IndexSpec("a", "field", analyzed=False), IndexSpec("b", "field", analyzed=False)])
TEXT = Registry([IndexSpec("SearchableText", "text"), IndexSpec("Title", "text")])
PLAIN = Settings(buckets=4, search_only=frozenset(), retries=0)


def rows_of(store):
    return sorted((r["uid"], r["a"], r["b"]) for r in store.rows().collect())


def test_store_replay_and_untouched_buckets(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path), REGISTRY, PLAIN)
    assert not store.active and store.current() is None
    feed = spark.createDataFrame([("1", 1, "index", [], ("x", "y"))], FEED)
    assert commit_batch(store, feed, 0) is None
    store.convert()
    assert store.convert().number == 1 and store.clear().number == 1
    store.rebuild(spark.createDataFrame([(str(n), "x", "y") for n in range(40)], ROWS))
    change = changes.compact(
        spark.createDataFrame([("7", 1, "reindex", ["a"], ("z", None)), ("8", 2, "unindex", [], None)], FEED),
        store.attributes,
    )
    done = store.commit(change, batch_id=5)
    assert (done.updated, done.indexed, done.deleted, done.refused.count()) == (1, 0, 1, 0)
    after = store.current()
    # only the changed row is written
    assert store._read("docs", store.schema, after).where(F.col("v") == after.overlays[-1]).count() == 1
    assert store.commit(change, batch_id=5) is None and store.current() == after
    assert ("7", "z", "y") in rows_of(store) and len(rows_of(store)) == 39
    # the base keeps its bucket count, whatever the settings say now
    other = IndexStore(spark, str(tmp_path), REGISTRY, replace(PLAIN, buckets=9))
    change = spark.createDataFrame([(str(n), 9, "reindex", ["b"], (None, "w")) for n in range(10, 20)], FEED)
    assert commit_batch(other, change).refused.isEmpty()
    assert sum(row[2] == "w" for row in rows_of(other)) == 10
    kept = rows_of(store)
    # the overlay is a large share of this small index
    assert store.merge().overlays == () and rows_of(store) == kept
    store.vacuum()
    parts = [part.name for part in (tmp_path / "site" / "docs").glob("v=*")]
    assert rows_of(store) == kept and parts == [f"v={store.current().base}"]


def test_overlays_keep_scores_and_counts_exact(spark, tmp_path):
    """After many commits a search scores as on an index built at once; so it does merged."""
    settings = Settings(buckets=3, search_only=frozenset(), retries=0, merge_after=100)
    grown = IndexStore(spark, str(tmp_path / "grown"), TEXT, settings)
    texts = {str(n): (f"alpha {'beta ' * (n % 3)}gamma{n % 4}", f"Title {n}") for n in range(20)}
    schema = "uid string, SearchableText string, Title string"

    def frame(rows):
        return spark.createDataFrame([(uid, *row) for uid, row in rows.items()], schema)

    grown.rebuild(frame(texts))
    feed = "uid string, seq long, op string, attributes array<string>, payload struct<SearchableText:string,Title:string>"
    steps = [
        [("3", 1, "reindex", ["SearchableText"], ("beta beta alphabet", None)), ("4", 1, "unindex", [], None)],
        [("4", 1, "index", [], ("alpha back", "Beta")), ("3", 1, "reindex", ["Title"], (None, "Alphabetic"))],
        [("5", 1, "unindex", [], None), ("77", 1, "index", [], (None, None)), ("3", 2, "unindex", [], None)],
    ]
    for batch, step in enumerate(steps):
        commit_batch(grown, spark.createDataFrame(step, feed), batch)
    for uid in ("3", "5"):
        del texts[uid]
    texts |= {"4": ("alpha back", "Beta"), "77": (None, None)}
    whole = IndexStore(spark, str(tmp_path / "whole"), TEXT, settings)
    whole.rebuild(frame(texts))
    assert len(grown.current().overlays) == 3
    for step in ("overlays", "one overlay", "base"):
        if step == "one overlay":
            assert len(IndexStore(spark, str(tmp_path / "grown"), TEXT, replace(settings, merge_share=1.0)).merge().overlays) == 1
        elif step == "base":
            assert IndexStore(spark, str(tmp_path / "grown"), TEXT, replace(settings, merge_share=0.0)).merge().overlays == ()
        for query in ({"SearchableText": "alpha beta"}, {"Title": "title alph"}, {"Title": "b"}):
            found = [
                {r["uid"]: round(r["score"], 9) for r in s.index().search(query).hits.select("uid", "score").collect()}
                for s in (grown, whole)
            ]
            assert found[0] == found[1]
        assert sorted(grown.rows().select("uid").collect()) == sorted(whole.rows().select("uid").collect())


def test_folding_is_a_job_of_its_own(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path), REGISTRY, Settings(buckets=2, search_only=frozenset(), merge_after=2, merge_share=1.0))
    store.rebuild(spark.createDataFrame([(str(n), "x", "y") for n in range(10, 40)], ROWS))
    for n in range(3):
        assert store.crowded == (n >= 2)
        commit_batch(store, spark.createDataFrame([(str(n), 1, "index", [], ("x", "y"))], FEED), n)
    assert len(store.current().overlays) == 3
    kept = rows_of(store)
    assert len(store.merge().overlays) == 1 and rows_of(store) == kept and len(kept) == 33
    assert store.merge().number == store.current().number
    # what was applied before the fold stays applied
    assert commit_batch(store, spark.createDataFrame([("1", 1, "unindex", [], None)], FEED), 1) is None


def test_two_commits_from_one_head(spark, tmp_path, monkeypatch):
    """A writer that finds its version taken applies its batch to what the other left."""
    store = IndexStore(spark, str(tmp_path), TEXT, PLAIN)
    schema = "uid string, SearchableText string, Title string"
    store.rebuild(spark.createDataFrame([("a", "old words", "A"), ("b", "old words", "B")], schema))
    feed = "uid string, seq long, op string, attributes array<string>, payload struct<SearchableText:string,Title:string>"
    other = IndexStore(spark, str(tmp_path), TEXT, PLAIN)
    first = spark.createDataFrame([("a", 1, "reindex", ["Title"], (None, "changed")), ("c", 1, "index", [], ("new", "C"))], feed)
    second = spark.createDataFrame([("a", 2, "reindex", ["SearchableText"], ("other words", None)), ("d", 2, "index", [], ("new", "D"))], feed)
    write, calls = IndexStore._write_overlay, []

    def meanwhile(self, *args, **options):
        write(self, *args, **options)
        calls.append(1)
        if len(calls) == 1:
            assert commit_batch(other, first, 7) is not None

    monkeypatch.setattr(IndexStore, "_write_overlay", meanwhile)
    done = store.commit(changes.compact(second, store.attributes), 3, "attachments")
    # one attempt lost to the other writer, one of that writer, one on the new head
    assert len(calls) == 3 and done.version.number == 3 and len(store.current().overlays) == 2
    rows = {r["uid"]: (r["SearchableText"], r["Title"]) for r in store.rows().collect()}
    assert rows == {"a": ("other words", "changed"), "b": ("old words", "B"), "c": ("new", "C"), "d": ("new", "D")}
    assert store.index().search({"SearchableText": "old"}).count() == 1
    # each stream has its own last batch
    assert store.current().applied == {"changes": 7, "attachments": 3}
    assert commit_batch(store, first, 7) is None and commit_batch(store, first, 8) is not None


def test_a_narrow_payload_is_no_full_index(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path), REGISTRY, PLAIN)
    store.rebuild(spark.createDataFrame([("1", "x", "y")], ROWS))
    narrow = "uid string, seq long, op string, attributes array<string>, payload struct<b:string>"
    feed = spark.createDataFrame([("1", 1, "reindex", ["b"], ("z",)), ("2", 1, "reindex", ["b"], ("z",))], narrow)
    done = commit_batch(store, feed, 1)
    assert (done.indexed, done.updated) == (0, 2) and [r["uid"] for r in done.refused.collect()] == ["2"]
    assert rows_of(store) == [("1", "x", "z")]


def test_log_stays_short(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("findlark.plans.store.KEPT_VERSIONS", 3)
    store = IndexStore(spark, str(tmp_path), REGISTRY, PLAIN)
    store.rebuild(spark.createDataFrame([(str(n), "x", "y") for n in range(5)], ROWS))
    for n in range(4):
        commit_batch(store, spark.createDataFrame([(str(n), 1, "unindex", [], None)], FEED), n)
    store.count_queries(4)
    assert [r["version"] for r in store.versions().orderBy("version").collect()] == [4, 5, 6]
    assert store.current().deleted_total == 4 and store.current().queries_total == 4
    # a writer that stopped inside its last step is passed over
    (tmp_path / "site" / "versions" / "7.json").write_text("{")
    assert store.current().number == 6 and store.recreate().number == 8


def test_buckets_follow_the_text(spark, tmp_path):
    settings = Settings(search_only=frozenset(), bucket_bytes=1000)
    store = IndexStore(spark, str(tmp_path), TEXT, settings)
    rows = [(str(n), "word " * 50, None) for n in range(20)]
    version = store.rebuild(spark.createDataFrame(rows, "uid string, SearchableText string, Title string"))
    assert version.buckets == 6 and store.index().search({"SearchableText": "word"}).count() == 20


def test_clear_abort_and_inactive_store(spark, tmp_path):
    feed = spark.createDataFrame([("1", 1, "index", [], ("x", "y"))], FEED)
    store = IndexStore(spark, str(tmp_path), REGISTRY, PLAIN)
    # not converted: changes are ignored
    assert not store.active and commit_batch(store, feed) is None
    assert store.clear().number == 1 and store.clear().number == 1
    off = IndexStore(spark, str(tmp_path), REGISTRY, replace(PLAIN, enabled=False))
    assert not off.active and commit_batch(off, feed) is None and off.clear().number == 1
    # pending actions that are never committed leave nothing
    changes.compact(feed, store.attributes)
    assert rows_of(store) == [] and commit_batch(store, feed).indexed == 1


def test_no_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from findlark.config import shared_dir

    unset = SimpleNamespace(get=lambda name, default=None: default)
    context = SimpleNamespace(master="spark://host:7077", applicationId="a")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf=unset, sparkContext=context))


def test_unpublished_files_are_not_read(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path), REGISTRY, PLAIN)
    store.rebuild(spark.createDataFrame([("1", "x", "y")], ROWS))
    store._write_base(spark.createDataFrame([("2", "lost", "lost")], ROWS), 2)
    assert rows_of(store) == [("1", "x", "y")]
    store.rebuild(spark.createDataFrame([("3", "x", "y")], ROWS))
    assert rows_of(store) == [("3", "x", "y")]


def test_synchronize_uncatalog_and_info(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path), REGISTRY, PLAIN, site="/My/Site")
    assert store.name == "my-site"
    store.rebuild(spark.createDataFrame([("1", "x", "y"), ("9", "x", "y")], ROWS))
    content = spark.createDataFrame([("1", "x", "y", "/p1"), ("2", "n", "m", "/p2")], f"{ROWS}, path string")
    assert jobs.synchronize(store, content) == {"indexed": 1, "deleted": 1}
    assert jobs.synchronize(store, content) == {"indexed": 0, "deleted": 0}
    assert rows_of(store) == [("1", "x", "y"), ("2", "n", "m")]
    gone = spark.createDataFrame([("/p1",), ("/nowhere",)], "path string")
    assert jobs.uncatalog(store, content, gone).deleted == 1
    store.count_queries(3)
    found = jobs.info(store, content).first()
    assert (found["catalog_docs"], found["index_docs"], found["deleted_docs"], found["query_count"]) == (2, 1, 2, 3)
    assert found["size"] == "1 MB"


def test_equal_buckets_are_not_compared(spark, tmp_path):
    """Only the buckets whose digests differ are read again and joined."""
    store = IndexStore(spark, str(tmp_path), REGISTRY, replace(PLAIN, buckets=16))
    ids = [str(n) for n in range(300)]
    store.rebuild(spark.createDataFrame([(uid, "x", "y") for uid in ids], ROWS))
    content = spark.createDataFrame([(uid, "x", "y") for uid in ids if uid != "42"] + [("42b", "n", "m")], ROWS)
    catalog, rows = store.apart(content)
    near = [set(r["uid"] for r in side.collect()) for side in (catalog, rows)]
    assert near[0] ^ near[1] == {"42", "42b"} and len(near[1]) < 100
    plan = rows._jdf.queryExecution().executedPlan().toString()
    folders = plan.split("PartitionFilters: [")[1].split("]")[0]
    # the overlays' folder and those of at most two buckets
    assert "bucket" in folders and 2 <= len(re.findall(r"-?\d+(?=[,)])", folders.split("IN")[-1])) <= 3, folders
    assert jobs.synchronize(store, content) == {"indexed": 1, "deleted": 1}
    catalog, rows = store.apart(content)
    assert catalog.isEmpty() and rows.isEmpty()
    # an id the catalog holds twice, and null ids, change nothing
    again = content.unionByName(content.where("uid = '7'")).unionByName(spark.createDataFrame([(None, "x", "y")], ROWS))
    assert jobs.synchronize(store, again) == {"indexed": 0, "deleted": 0}
    assert sorted(r[0] for r in rows_of(store)) == sorted((set(ids) - {"42"}) | {"42b"})


def test_reserved_names_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        IndexStore(spark, str(tmp_path), Registry([IndexSpec("bucket", "field")]))


def test_retries():
    calls = []

    def failing():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("not yet")
        return "done"

    assert with_retries(failing, 3, 0) == "done" and len(calls) == 3
    calls.clear()
    with pytest.raises(RuntimeError):
        with_retries(failing, 1, 0)


FILES = "uid string, fieldname string, filename string, data binary"


def test_stream_with_attachments(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"), TEXT, Settings(buckets=2, search_only=frozenset(), retries=0))
    store.convert()
    feed_type = "uid string, seq long, op string, attributes array<string>, payload struct<SearchableText:string,Title:string>"
    feed_path, file_path = str(tmp_path / "feed"), str(tmp_path / "files")
    spark.createDataFrame(
        [("d1", 1, "index", [], ("hello", "First")), ("d2", 2, "index", [], ("other", "Second")), ("d3", 3, "unindex", [], None)],
        feed_type,
    ).write.parquet(feed_path)
    spark.createDataFrame(
        [
            ("d1", "file2", "b.txt", b" second part"),
            ("d1", "file", "a.html", b"<p>first <b>part</b></p>"),
            ("d2", "file", "x.bin", b"\x00\x01"),
            ("d3", "file", "gone.txt", b"never"),
        ],
        FILES,
    ).write.parquet(file_path)
    feed = spark.readStream.schema(feed_type).parquet(feed_path)
    files = spark.readStream.schema(FILES).parquet(file_path)
    drain(store, feed, files, str(tmp_path / "progress"))
    rows = {r["uid"]: r for r in store.rows().collect()}
    assert set(rows) == {"d1", "d2"}
    assert rows["d1"]["SearchableText"] == "hellofirst partsecond part"
    assert [a["fieldname"] for a in rows["d1"]["attachments"]] == ["file", "file2"]
    assert all(a["data"] is None for a in rows["d1"]["attachments"])
    assert rows["d2"]["attachments"][0]["data"] == b"\x00\x01" and rows["d2"]["SearchableText"] == "other"
    assert store.index().search({"SearchableText": "second part"}).count() == 1
    versions = store.current().number
    drain(store, feed, files, str(tmp_path / "progress"))
    assert store.current().number == versions
    # the text is indexed again without its second file
    again = spark.createDataFrame([("d1", 9, "index", [], ("hello", "First"))], feed_type)
    commit_batch(store, again)
    commit_files(store, spark.createDataFrame([("d1", "file", "a.txt", b" first")], FILES))
    assert store.index().search({"SearchableText": "second part"}).count() == 0
    assert store.rows().where("uid = 'd1'").first()["SearchableText"] == "hellofirst"


def test_deferred_values_are_read_at_apply_time(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "i"), REGISTRY, Settings(buckets=2, search_only=frozenset(), deferred=True, retries=0))
    store.rebuild(spark.createDataFrame([("1", "old", "old"), ("2", "old", "old")], ROWS))
    names = [("1", 1, "reindex", ["a"], None), ("2", 2, "unindex", [], None), ("3", 3, "index", [], None), ("4", 4, "index", [], None)]
    path = str(tmp_path / "feed")
    spark.createDataFrame(names, FEED).write.parquet(path)
    current = spark.createDataFrame([("1", "new", "new"), ("3", "c", "d")], ROWS)
    stream = spark.readStream.schema(FEED).parquet(path)
    follow_feed(store, stream, str(tmp_path / "p"), current=lambda: current).awaitTermination()
    assert rows_of(store) == [("1", "new", "old"), ("3", "c", "d")]


def test_failed_batch_is_not_published(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "i"), REGISTRY, Settings(buckets=2, search_only=frozenset(), deferred=True, retries=1, retry_seconds=0))
    store.rebuild(spark.createDataFrame([("1", "old", "old")], ROWS))
    path, progress = str(tmp_path / "feed"), str(tmp_path / "p")
    spark.createDataFrame([("1", 1, "reindex", ["a"], None)], FEED).write.parquet(path)
    stream = spark.readStream.schema(FEED).parquet(path)
    tried = []

    def unreachable():
        tried.append(1)
        raise RuntimeError("content is unreachable")

    with pytest.raises(Exception, match="unreachable"):
        follow_feed(store, stream, progress, current=unreachable).awaitTermination()
    assert len(tried) == 2 and rows_of(store) == [("1", "old", "old")]
    current = spark.createDataFrame([("1", "new", "new")], ROWS)
    follow_feed(store, stream, progress, current=lambda: current).awaitTermination()
    assert rows_of(store) == [("1", "new", "old")]
