"""Phrases, positions, ranks, catalog rows and sources against brute force."""

from __future__ import annotations

import itertools
import random
import re
from datetime import UTC, date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from findlark import IndexSpec, Registry, Settings
from findlark.functions import text as X
from findlark.functions import values as V
from findlark.operators import attachments as A
from findlark.operators import ordering, postings
from findlark.operators.catalogjoin import join_catalog
from findlark.operators.positions import changed_positions, container_positions, move_members
from findlark.operators.predicates import predicate
from findlark.operators.textmatch import Clause, ScannedText, match_text, text_clauses
from findlark.plans.search import SearchIndex
from findlark.registry import default_registry
from findlark.sources import hierarchy as H
from findlark.sources.blobs import blob_fields, list_blobs, open_uri, read_blobs, write_blobs
from findlark.sources.content import derive_rows
from findlark.sources.pages import link_frontier, page_documents, page_links

# --- text ---


def brute_spread(words, phrase, slop):
    at = [[i for i, w in enumerate(words) if w == p] for p in phrase]
    best = None
    for choice in itertools.product(*at):
        if len(set(choice)) < len(choice):
            continue
        aligned = [p - i for i, p in enumerate(choice)]
        width = max(aligned) - min(aligned)
        if width <= slop and (best is None or width < best):
            best = width
    return best


@pytest.mark.parametrize("phrase", [("a", "b"), ("a", "b", "c"), ("a", "a"), ("a", "b", "a"), ("c",), ("b", "a", "b", "a")])
def test_phrase_equals_brute_force(spark, phrase):
    rng = random.Random(5)
    docs = [(str(n), " ".join(rng.choice("abcd") for _ in range(rng.randint(1, 9)))) for n in range(300)]
    frame = spark.createDataFrame(docs, "uid string, Body string")
    got = {r["uid"] for r in match_text(ScannedText(frame), [Clause("phrase", "Body", phrase)]).select("uid").collect()}
    assert got == {uid for uid, text in docs if brute_spread(text.split(), phrase, 2) is not None}


def test_prefix_equals_brute_force(spark):
    rng = random.Random(6)
    docs = [(str(n), " ".join(rng.choice(["ab", "abc", "b", "bc", "c"]) for _ in range(5))) for n in range(200)]
    frame = spark.createDataFrame(docs, "uid string, Title string")
    got = {r["uid"] for r in match_text(ScannedText(frame), [Clause("prefix", "Title", ("b", "ab"))]).select("uid").collect()}
    assert got == {uid for uid, text in docs if re.search(r"(^| )b ab", text)}


def test_clauses_of_a_field():
    kinds = {name: [(c.kind, c.field) for c in text_clauses(name, "*x*")] for name in ("Title", "SearchableText", "Other")}
    assert kinds["Title"] == [("phrase", "Title"), ("prefix", "Title")]
    assert kinds["SearchableText"] == [("phrase", "SearchableText"), ("prefix", "Title"), ("any", "SearchableText")]
    assert kinds["Other"] == [("phrase", "Other"), ("any", "Other")]
    assert text_clauses("Other", None)[0].words == ()


def test_scan_search_needs_no_shuffle_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("string").alias("uid"), "text")
    found = match_text(ScannedText(docs), [Clause("phrase", "text", ("the", "of"))])
    plan = found.select("uid", "score")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert plan.split("Generate")[1].count("regexp_extract_all") == 1


def test_postings_are_inverted_in_place(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("string").alias("uid"), "text")
    built = postings.build_postings(docs, ["text"])
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") > plan.index("posexplode")
    row = built.where("uid = '1'").orderBy("term").first()
    words = X.query_tokens(docs.where("uid = '1'").first()["text"])
    assert row["positions"] == [i for i, w in enumerate(words) if w == row["term"]]


def test_fold_and_bytes(spark):
    row = spark.createDataFrame([("Žluťoučký Straße Ørsted Ægir", b"ok\xff\xc3\xa9")], "t string, b binary").select(
        X.fold_ascii(F.col("t")), X.bytes_to_text(F.col("b")), X.trim_stars(F.lit("**a*b*"))
    ).first()
    assert tuple(row) == ("Zlutoucky Strasse Orsted AEgir", "oké", "a*b")


def test_long_words_make_their_own_fragment(spark):
    text = "x" * 150 + " " + "word " * 40
    found = spark.createDataFrame([(text,)], "t string").select(X.fragments(F.col("t"))).first()[0]
    assert found[0] == "x" * 150 and all(len(f) <= 100 for f in found[1:])
    assert " ".join(found) == text.strip()


# --- predicates ---


@pytest.mark.parametrize(
    ("name", "value"),
    [
        ("portal_type", None),
        ("portal_type", ""),
        ("portal_type", []),
        ("portal_type", {"query": ""}),
        ("created", {"query": None, "range": "min"}),
        ("created", {"query": datetime(2020, 1, 1)}),
        ("created", {"query": ["2020-01-01"] * 3, "range": "minmax"}),
        ("path", {"query": []}),
    ],
)
def test_no_constraint(spark, name, value):
    registry = default_registry()
    assert predicate(registry[name], value, registry.struct_type()) is None


def test_filters_reach_the_scan(spark, tmp_path):
    registry = default_registry()
    rows = derive_rows(spark.createDataFrame([("1", "/site/a", "Event")], "uid string, path string, portal_type string"), registry)
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    found = SearchIndex(stored, registry).search(
        {"portal_type": ["Event", "X"], "created": {"query": "2020-01-01", "range": "max"}, "path": "/site"}
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = found.fields("portal_type")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for pushed in ("In(portal_type", "LessThanOrEqual(created", "StringStartsWith(path.path"):
        assert pushed in plan
    assert "SearchableText" not in plan.split("ReadSchema")[1]


def test_dates_and_names():
    assert V.to_instant(date(2020, 1, 2)) == datetime(2020, 1, 2, tzinfo=UTC)
    assert V.to_instant("2020/01/02") == datetime(2020, 1, 2, tzinfo=UTC)
    assert V.index_name("/Plain/Catalog") == "plain-catalog"
    assert V.index_name("/a/b", version=3) == "a-b_3"
    assert V.index_name("/a", custom="own", version=3) == "own"


def test_registry_schema():
    registry = Registry().with_specs(IndexSpec("extra", "field"), IndexSpec("Title", "keyword"))
    schema = registry.struct_type(["Body"])
    assert schema["extra"].metadata == {"kind": "field", "analyzed": True, "stored": False}
    assert schema["Title"].metadata["kind"] == "keyword" and schema["Title"].metadata["stored"]
    assert schema["Body"].metadata["kind"] == "text"
    assert "attachments" in schema.names
    with pytest.raises(ValueError):
        IndexSpec("x", "unheard-of")
    assert registry.all_attributes(["Title", "Body"])[-1] == "Body"


def test_path_of_another_type_is_refused(spark):
    with pytest.raises(TypeError):
        derive_rows(spark.createDataFrame([("1", 5)], "uid string, path int"), Registry([IndexSpec("path", "path")]))


# --- order ---


def test_ranks_with_one_hot_key(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("uid"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).alias("k"))
    got = ordering.ranked(rows, [F.desc("k"), F.asc("uid")]).collect()
    expected = sorted(((r["uid"], r["k"]) for r in rows.collect()), key=lambda r: (-r[1], r[0]))
    assert [(r["uid"], r["k"]) for r in sorted(got, key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in got) == list(range(5000))


def test_positions_of_containers_over_many_ranges(spark):
    rng = random.Random(2)
    sizes = {0: 3, 1: 4000, 2: 1, 3: 1, 4: 900, 5: 2500, 6: 2, 7: 600}
    rows = [(p, f"m{i:05d}", rng.random()) for p, size in sizes.items() for i in range(size)]
    frame = spark.createDataFrame(rows, "parent int, member string, ord double").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = container_positions(frame, "parent", "member", "ord").collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = {}
    for parent in sizes:
        inside = sorted((o, m) for p, m, o in rows if p == parent)
        expected |= {(parent, m): i for i, (_, m) in enumerate(inside)}
    assert {(r["parent"], r["member"]): r["position"] for r in got} == expected
    assert len(got) == len(rows)


def simulate(order, moved, delta):
    """Members moved one after another, nearest to the edge first."""
    order = list(order)
    lowest = 0
    ids = [m for m in order if m in moved]
    if delta > 0:
        order.reverse()
        ids.reverse()
    for member in ids:
        old = order.index(member)
        new = max(old - abs(delta), lowest)
        if new == lowest:
            lowest += 1
        order.remove(member)
        order.insert(new, member)
    return order[::-1] if delta > 0 else order


def test_moves_equal_simulation(spark):
    rng = random.Random(9)
    members, moves, expected = [], [], {}
    for parent in range(60):
        size = rng.randint(1, 9)
        names = [f"m{i}" for i in range(size)]
        moved = rng.sample(names, rng.randint(1, size))
        delta = rng.choice([-9, -3, -2, -1, 1, 2, 4, 9])
        members += [(parent, name, i) for i, name in enumerate(names)]
        moves += [(parent, name, delta) for name in moved]
        expected |= {(parent, m): i for i, m in enumerate(simulate(names, moved, delta))}
    members.append((999, "still", 0))
    placed = container_positions(spark.createDataFrame(members, "parent int, member string, ord int"), "parent", "member", "ord")
    after = move_members(placed, spark.createDataFrame(moves, "parent int, member string, delta int"), "parent", "member")
    got = {(r["parent"], r["member"]): r["position_after"] for r in after.collect()}
    assert got == expected
    changed = {(r["parent"], r["member"]) for r in changed_positions(after).collect()}
    before = {(p, m): o for p, m, o in members}
    assert changed == {key for key, place in expected.items() if place != before[key]}


@pytest.mark.parametrize("delta", [-40, 25])
def test_many_moves_in_one_container(spark, delta):
    """10,000 moves in one container next to small ones; nothing is gathered per container."""
    rng = random.Random(5)
    size, names = 12_000, [f"m{i:05d}" for i in range(12_000)]
    picked = sorted(rng.sample(names, 10_000))
    members = [(1, name, i) for i, name in enumerate(names)] + [(k, "a", 0) for k in range(2, 30)]
    moves = [(1, name, delta) for name in picked] + [(3, "a", delta), (77, "b", delta), (4, "unknown", delta)]
    placed = container_positions(spark.createDataFrame(members, "parent int, member string, ord int"), "parent", "member", "ord")
    after = move_members(placed, spark.createDataFrame(moves, "parent int, member string, delta int"), "parent", "member")
    plan = after._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    got = {(r["parent"], r["member"]): r["position_after"] for r in after.collect()}
    # targets, clamped so that moved members keep their order; the others fill what is free
    targets = {}
    for turn, name in enumerate(picked):
        goal = int(name[1:]) + delta
        targets[name] = max(goal, turn) if delta < 0 else min(goal, size - len(picked) + turn)
    free = sorted(set(range(size)) - set(targets.values()))
    expected = {(1, n): p for n, p in targets.items()} | {(3, "a"): 0}
    expected |= {(1, n): p for n, p in zip([n for n in names if n not in targets], free)}
    assert got == expected


# --- catalog rows ---


def test_catalog_rows(spark):
    hits = spark.createDataFrame([("1", "/a"), ("2", "/b"), ("3", None), ("4", "/nowhere")], "uid string, path string")
    catalog = spark.createDataFrame([("/a", 10, "A")], "path string, rid int, Title string")
    records = spark.createDataFrame([("/a", "stale"), ("/b", "Gone Event")], "path string, Title string")
    rows = {r["uid"]: r["row"] for r in join_catalog(hits, catalog, records).collect()}
    assert tuple(rows["1"]) == (10, "A") and tuple(rows["2"]) == (-1, "Gone Event")
    assert rows["3"] is None and tuple(rows["4"]) == (-1, None)
    own = hits.withColumn("Title", F.concat(F.lit("t"), "uid"))
    rows = {r["uid"]: r["row"] for r in join_catalog(own, catalog).collect()}
    assert tuple(rows["1"]) == (10, "A") and tuple(rows["2"]) == (-1, "t2") and rows["3"] is None
    assert join_catalog(own, catalog)._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_page_with_catalog_rows_keeps_order(spark):
    registry = Registry([IndexSpec("n", "field", analyzed=False), IndexSpec("path", "path")])
    rows = spark.range(30).select(
        F.col("id").cast("string").alias("uid"), F.format_string("%02d", "id").alias("n"), V.path_struct(F.format_string("/d/%d", "id")).alias("path")
    )
    catalog = rows.where("n < '25'").select("path.path", F.col("uid").cast("int").alias("rid"))
    found = SearchIndex(rows, registry, Settings(bulk_size=10)).search({"sort_on": "n", "sort_order": "desc"})
    got = [(r["n"], r["row"]["rid"]) for r in found.page_rows(0, catalog).collect()]
    assert got == [(f"{n:02d}", n if n < 25 else -1) for n in range(29, 19, -1)]


# --- sources ---


def test_only_wanted_files_are_opened(spark, tmp_path):
    """Files of other objects and fields are listed, never opened: reading one of them fails."""
    base = f"file:{tmp_path}/blobs"
    rows = [(f"doc {n}", field, f"{n} {field}".encode()) for n in range(20) for field in ("file", "file2")]
    written = write_blobs(spark.createDataFrame(rows, "path string, fieldname string, data binary"), base).collect()
    assert sorted((r["path"], r["fieldname"], r["length"]) for r in written) == sorted((p, f, len(d)) for p, f, d in rows)
    assert list_blobs(spark, base).count() == 40 and not list((tmp_path / "blobs").rglob(".*"))
    wanted = [(f"u{n}", "file", f"doc {n}", "x.txt") for n in (3, 7, 19)] + [("u99", "file", "doc 99", "x.txt")]
    fields = spark.createDataFrame(wanted, "uid string, fieldname string, path string, filename string")

    def careful(uri):
        assert uri.endswith(("doc 3/@@download/file", "doc 7/@@download/file", "doc 19/@@download/file")), uri
        return open_uri(uri)

    read = {r["uid"]: bytes(r["data"]) for r in read_blobs(spark, base, fields, careful).collect()}
    assert read == {f"u{n}": f"{n} file".encode() for n in (3, 7, 19)}


def test_blob_fields_and_bytes(spark, tmp_path):
    base = tmp_path / "site data"
    for path, field, data in (("folder/doc", "file", b"one"), ("folder/doc", "file2", b"two"), ("x", "file", b"other")):
        target = base / path / "@@download"
        target.mkdir(parents=True, exist_ok=True)
        (target / field).write_bytes(data)
    content = spark.createDataFrame(
        [
            (
                "u1",
                "/site/folder/doc",
                {"file": ("a.txt", "text/plain"), "file2": ("b.pdf", "application/pdf"), "image": ("c.png", "image/png"), "none": (None, None)},
            ),
            ("u2", "/site/bare", {}),
        ],
        "uid string, path string, files map<string,struct<filename:string,content_type:string>>",
    )
    fields = blob_fields(content, "/site")
    assert sorted((r["fieldname"], r["path"], r["filename"]) for r in fields.collect()) == [
        ("file", "folder/doc", "a.txt"),
        ("file2", "folder/doc", "b.pdf"),
    ]
    read = {r["fieldname"]: bytes(r["data"]) for r in read_blobs(spark, str(base), fields).collect()}
    assert read == {"file": b"one", "file2": b"two"}


def test_extractor_of_the_caller(spark):
    @F.pandas_udf("string")
    def reverse(name: pd.Series, data: pd.Series) -> pd.Series:
        return pd.Series([bytes(d).decode()[::-1] if n.endswith(".rev") else None for n, d in zip(name, data)])

    files = spark.createDataFrame(
        [("u", "file", "a.rev", b"cba"), ("u", "file2", "b.bin", b"xyz")], "uid string, fieldname string, filename string, data binary"
    )
    rows = spark.createDataFrame([("u", "text:"), ("v", None)], "uid string, SearchableText string")
    filled = A.append_contents(rows, A.collect_attachments(A.extract_contents(files, reverse)), separator=" ")
    got = {r["uid"]: r for r in filled.collect()}
    assert got["u"]["SearchableText"] == "text: abc" and got["v"]["SearchableText"] is None
    assert [a["data"] and bytes(a["data"]) for a in got["u"]["attachments"]] == [None, b"xyz"]


def test_encyclopedia_pages(spark):
    html = (
        '<h1 id="firstHeading" class="x">Café <i>Noir</i></h1><div id="bodyContent"><p>Body</p>'
        '<a href="/wiki/One">1</a><a class="y" href="/other">2</a><a href="https://en.example.org/wiki/Two">3</a></div>'
    )
    pages = spark.createDataFrame([("p", html), ("q", "<p>nothing</p>")], "url string, html string")
    docs = page_documents(pages).collect()
    assert [(d["url"], d["title"]) for d in docs] == [("p", "Cafe Noir")]
    assert docs[0]["body"].startswith('<div id="bodyContent">') and docs[0]["body"].endswith("</div>")
    parsed = spark.createDataFrame([("https://en.example.org/wiki/Two",)], "url string")
    links = page_links(pages, "https://en.example.org")
    assert [r["url"] for r in link_frontier(links, parsed, "https://en.example.org/wiki/").collect()] == [
        "https://en.example.org/wiki/One"
    ]


def test_hierarchy_is_depth_first(spark):
    def walk(prefix, depth):
        for n in range(3):
            path = f"{prefix}folder{n}"
            yield path
            if depth > 1:
                yield from walk(f"{path}/", depth - 1)

    expected = list(walk("", 3))
    got = spark.range(H.folder_count(3, 3)).orderBy("id").select(H.folder_path(F.col("id"), 3, 3)).collect()
    assert [r[0] for r in got] == expected
    assert H.folder_count() * (H.PAGES_PER_FOLDER + 1) == 79_254
    assert H.folder_rows(spark, depth=2, folders=2).count() == 6
