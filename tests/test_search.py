"""Searches over a small library, each compared with a plain Python model of the rule under test."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from findlark import IndexSpec, Registry, Settings, default_registry
from findlark.operators import changes
from findlark.plans import jobs
from findlark.plans.search import SearchIndex
from findlark.plans.store import IndexStore
from findlark.sources.content import derive_rows

LIBRARY = (
    "uid string, id string, getId string, portal_type string, Title string, Description string, "
    "SearchableText string, object_provides array<string>, created timestamp, effective timestamp, "
    "expires timestamp, path string, is_default_page boolean, getObjPositionInParent int, "
    "allowedRolesAndUsers array<string>"
)
NOW = datetime(2031, 3, 9, 7, tzinfo=UTC)
DAY = timedelta(days=1)


def library(spark, books):
    """Books with defaults for what a test does not care about."""
    rows = []
    for n, book in enumerate(books):
        name = book.get("id", f"book-{n}")
        rows.append({
            "uid": f"b{n:05d}", "id": name, "getId": name, "portal_type": book.get("portal_type", "Novel"),
            "Title": book.get("Title", ""), "Description": book.get("Description", ""),
            "SearchableText": book.get("SearchableText", book.get("Title", "")),
            "object_provides": book.get("object_provides", []), "created": book.get("created", NOW),
            "effective": book.get("effective"), "expires": book.get("expires"),
            "path": book.get("path", f"/shelf/{name}"), "is_default_page": book.get("is_default_page", False),
            "getObjPositionInParent": n, "allowedRolesAndUsers": book.get("readers", ["everyone"]),
        })
    return spark.createDataFrame(rows, LIBRARY)


@pytest.fixture(params=["scanned", "stored"])
def build(request, spark, tmp_path):
    def make(books, settings=None):
        settings = settings or Settings(buckets=3)
        rows = derive_rows(library(spark, books), default_registry(), search_only=settings.search_only)
        if request.param == "scanned":
            return SearchIndex(rows, default_registry(), settings)
        store = IndexStore(spark, str(tmp_path), default_registry(), settings)
        store.rebuild(rows)
        return store.index()

    return make


def ids(found):
    return {row["getId"] for row in found.hits.select("getId").collect()}


def expected(books, test):
    return {b.get("id", f"book-{n}") for n, b in enumerate(books) if test(b)}


KINDS = [["lent"], ["lent", "signed"], ["signed"], [], ["map"]]
SHELF = [
    {"Title": f"{a} {b}", "object_provides": KINDS[(3 * i + j) % 5], "portal_type": ("Novel", "Atlas", "Score")[(i + j) % 3]}
    for i, a in enumerate(("quiet", "loud", "amber"))
    for j, b in enumerate(("harbour", "lantern", "harbour lantern", "orchard"))
]


@pytest.mark.parametrize("wanted", [["lent"], ["lent", "map"], ["signed"], ["none of these"]])
def test_keywords_with_words(build, wanted):
    index = build(SHELF)
    right = expected(SHELF, lambda b: set(wanted) & set(b["object_provides"]) and "harbour" in b["Title"])
    assert ids(index.search({"object_provides": wanted, "SearchableText": "Harbour"})) == right
    # sibling keys of a wrapped query are not looked at
    wrapped = {"object_provides": {"query": wanted, "operator": "and"}, "SearchableText": "harbour"}
    assert ids(index.search(wrapped)) == right


@pytest.mark.parametrize("unwanted", ["Atlas", ["Atlas", "Score"], ["Leaflet"]])
def test_not(build, unwanted):
    index = build(SHELF)
    out = {unwanted} if isinstance(unwanted, str) else set(unwanted)
    right = expected(SHELF, lambda b: b["portal_type"] not in out and "amber" in b["Title"])
    assert ids(index.search({"portal_type": {"not": unwanted}, "SearchableText": "amber"})) == right


def test_dates(build):
    books = [{"Title": "almanac", "created": NOW + k * DAY, "effective": NOW - 3 * k * DAY} for k in range(-2, 3)]
    index = build(books)

    def found(**spec):
        return ids(index.search({"SearchableText": "almanac", **spec}))

    low, high = NOW - DAY, NOW + DAY
    assert found(created={"query": (low, high), "range": "minmax"}) == expected(books, lambda b: low <= b["created"] <= high)
    assert found(created={"query": high, "range": "min"}) == expected(books, lambda b: b["created"] >= high)
    assert found(effective={"query": low, "range": "max"}) == expected(books, lambda b: b["effective"] <= low)
    # a list without a range is a lower bound, a single value without one no bound
    assert found(effective={"query": [NOW.isoformat()]}) == expected(books, lambda b: b["effective"] >= NOW)
    assert found(effective={"query": NOW}) == expected(books, lambda b: True)


def grove(depth=3):
    """A tree with one more leaf on every level: ``/grove``, its branches and their leaves."""
    paths, branch = [], "/grove"
    for level in range(depth):
        paths += [branch, *(f"{branch}/leaf-{level}-{k}" for k in range(level + 2))]
        branch += f"/branch-{level}"
    return [{"id": p.strip("/").replace("/", "."), "path": p, "Title": "rustle", "portal_type": "Leaf" if "leaf" in p else "Branch"} for p in paths]


SPECS = [
    ({"query": "/grove", "depth": 0}, "/grove", 0), ({"query": "/grove", "depth": 1}, "/grove", 1),
    ({"query": "/grove/branch-0", "depth": 2}, "/grove/branch-0", 2), ({"query": "/grove", "depth": -1}, "/grove", -1),
    ("/grove/branch-0/branch-1", "/grove/branch-0/branch-1", -1), ({"query": ["/grove/leaf-0-0", "/grove/leaf-0-1"]}, None, 0),
    ({"query": []}, "", -1),
]


@pytest.mark.parametrize(("spec", "root", "depth"), SPECS)
def test_paths(build, spec, root, depth):
    books = grove()
    index = build(books)

    def inside(book):
        path = book["path"]
        if root is None:
            return path in spec["query"]
        below = path[len(root) :].count("/")
        if depth == 0:
            return path == root
        return path.startswith(root) and (depth < 0 or 0 < below <= depth)

    right = expected(books, inside)
    assert right and ids(index.search({"path": spec})) == right
    assert ids(index.search({"path": spec, "SearchableText": "rustle"})) == right


def test_several_constraints_and_navigation(build):
    books = [*grove(), {"id": "elsewhere", "path": "/hedge/leaf", "Title": "rustle", "portal_type": "Leaf"}]
    index = build(books)
    query = {"path": {"query": "/grove", "depth": 1}, "portal_type": "Leaf", "is_default_page": False, "Title": "rustle"}
    assert ids(index.search(query)) == expected(books, lambda b: b["path"].startswith("/grove/leaf"))
    whole = {"query": "/grove", "navtree": 1, "navtree_start": 0}
    assert ids(index.search({"path": whole, "SearchableText": "rustle"})) == expected(books, lambda b: b["path"].startswith("/grove"))


# --- order and access ---

COUNT, PAGE = 37, 6


@pytest.fixture
def numbered(build):
    return build([{"id": f"vol{n:03d}", "Title": "volume"} for n in range(COUNT)], Settings(bulk_size=PAGE, buckets=2))


@pytest.mark.parametrize("query", [{"portal_type": "Novel"}, {"Title": "volume"}])
@pytest.mark.parametrize("order", ["ascending", "reverse"])
def test_access_by_place(numbered, query, order):
    model = sorted((f"vol{n:03d}" for n in range(COUNT)), reverse=order == "reverse")
    found = numbered.search({**query, "sort_on": "getId", "sort_order": order})
    assert len(found) == COUNT
    for place in (0, PAGE - 1, PAGE, COUNT - 1, -1, -PAGE, -COUNT):
        assert found[place]["getId"] == model[place]
    for place in (COUNT, -COUNT - 1):
        with pytest.raises(IndexError):
            found[place]
    for part in (slice(None), slice(4, 15), slice(-5, None), slice(30, 3, -4), slice(2, 20, 3), slice(9, 9)):
        assert [row["getId"] for row in found[part].collect()] == model[part]
    assert [r["getId"] for r in found.page(3, 4).collect()] == model[3:7]
    assert [r["getId"] for r in found.deep_page(20, 5).collect()] == model[20:25]
    assert len(found._pages) <= found.PAGES_KEPT


def test_ranked_tables_are_removed(spark, numbered):
    from pathlib import Path

    from findlark.config import shared_dir

    folder = Path(shared_dir(spark)) / "findlark"
    before = set(folder.glob("*")) if folder.exists() else set()
    with_text = numbered.search({"Title": "volume"})
    # access by place writes nothing, the whole ranking is a table
    assert with_text[0] is not None and with_text[-1] is not None
    assert (set(folder.glob("*")) if folder.exists() else set()) == before
    assert with_text.ranked().count() == COUNT and set(folder.glob("*")) > before
    with_text.close()
    assert set(folder.glob("*")) == before


# --- text ---


def test_title_phrase_comes_first(build):
    books = [{"Title": t} for t in ("amber lantern", "lantern of amber", "amber", "a lamp", "amber lanterns abound")]
    found = build(books).search({"Title": "amber lantern"})
    # exact, with one word between in the other order it is no phrase; the last begins with the words
    assert ids(found) == {"book-0", "book-4"} and found[0]["getId"] == "book-0"


def test_text_rules(build):
    index = build([
        {"Title": "cedar maple rowan", "Description": "north"},
        {"Title": "cedarwood chest", "Description": "cedar"},
        {"Title": "maple", "Description": "south"},
    ])
    cases = [
        ({"Title": "cedar"}, {0, 1}),  # a prefix in the title
        ({"Description": "cedar"}, {1}),
        ({"Title": "chest", "Description": "north"}, {0, 1}),  # clauses of all keys are or-ed
        ({"SearchableText": ""}, set()), ({"SearchableText": "*"}, set()),
        ({"Title": "*cedar maple*"}, {0}),
        ({"Title": "cedar rowan"}, {0}),  # one word between is within the slop
        ({"unheard-of": "x"}, {0, 1, 2}),
    ]
    for query, right in cases:
        assert ids(index.search(query)) == {f"book-{n}" for n in right}, query
    assert index.search({"SearchableText": ""}).hits.columns == index.search({"SearchableText": "x"}).hits.columns
    assert index.search({"unheard-of": "x"})[0]["score"] == 1.0
    assert index.search({"portal_type": "Novel"})[0]["score"] == 0.0


@pytest.mark.parametrize("stored", [False, True])
def test_rows_without_a_title(spark, tmp_path, stored):
    """A clause on a field that is not there matches nothing and disturbs no other."""
    registry = Registry([IndexSpec("SearchableText", "text")])
    rows = spark.createDataFrame([("1", "that sedge"), ("2", "reeds")], "uid string, SearchableText string")
    index = SearchIndex(rows, registry)
    if stored:
        store = IndexStore(spark, str(tmp_path), registry, Settings(buckets=2, search_only=frozenset()))
        store.rebuild(rows)
        index = store.index()
    assert [r["uid"] for r in index.search({"SearchableText": "sedge"}).hits.collect()] == ["1"]
    assert index.search({"Title": "sedge"}).count() == (0 if "Title" in index.settings.search_only else 2)


def test_search_only_field_after_partial_update(spark, tmp_path):
    """The field is not in the registry, is still searched, and forgets its old text."""
    registry = default_registry().without("SearchableText", "Title")
    store = IndexStore(spark, str(tmp_path), registry, Settings(buckets=2))
    books = [{"id": "wren", "Title": "dusk chorus", "Description": "birds"}, {"id": "owl", "Title": "night"}]
    jobs.rebuild(store, library(spark, books))
    assert ids(store.index().search({"SearchableText": "dusk"})) == {"wren"}
    changed = library(spark, [{"id": "wren", "Title": "dawn chorus", "Description": "birds"}])
    names = ["Title", "SearchableText"]
    feed = changes.feed_rows(jobs.extract_rows(store, changed, names), "reindex", F.lit(1).cast("long"), names)
    store.commit(changes.compact(feed, store.attributes))
    index = store.index()
    assert ids(index.search({"SearchableText": "dusk"})) == set()
    for query in ({"SearchableText": "dawn"}, {"Description": "birds"}, {"id": "wren"}):
        assert ids(index.search(query)) == {"wren"}


def test_scores_agree_between_sources(spark, tmp_path):
    books = [{"Title": f"heron {'marsh ' * (n % 4)}t{n}", "SearchableText": f"heron {'marsh ' * (n % 5)}x{n}"} for n in range(33)]
    rows = derive_rows(library(spark, books), default_registry())
    store = IndexStore(spark, str(tmp_path), default_registry(), Settings(buckets=4, files_per_bucket=2))
    store.rebuild(rows)
    query = {"SearchableText": "heron marsh"}
    found = [
        {r["uid"]: round(r["score"], 9) for r in index.search(query).hits.select("uid", "score").collect()}
        for index in (SearchIndex(rows, default_registry()), store.index(), SearchIndex(rows, default_registry(), Settings(scan_partitions=3)))
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) == 33


# --- highlighting, catalog rows, viewers ---


def test_highlight(build):
    settings = Settings(highlight=True, highlight_pre_tags="[", highlight_post_tags="]", buckets=2)
    index = build([{"id": "moth", "Title": "Lamp moths", "Description": "told"}, {"id": "bat", "Title": "Bats", "Description": "kept"}], settings)
    assert index.search({"SearchableText": "lamp"})[0]["Description"] == "[Lamp] moths"
    # no clause on the main text, so no extract
    assert index.search({"Title": "bats"})[0]["Description"] == "kept"


def test_number_and_length_of_fragments(build):
    text = " ".join(f"filler{k} tide" for k in range(60))
    for count, chars in ((1, 40), (3, 20)):
        settings = Settings(highlight=True, highlight_fragments=count, highlight_fragment_chars=chars, highlight_threshold=10_000, buckets=2)
        shown = build([{"Title": "t", "SearchableText": text}], settings).search({"SearchableText": "tide"})[0]["Description"]
        assert len(shown.split(" ... ")) == count and all(len(f) <= chars for f in shown.split(" ... "))


def test_catalog_rows_show_the_extract(spark, build):
    settings = Settings(highlight=True, highlight_pre_tags="<", highlight_post_tags=">", buckets=2)
    books = [{"id": f"k{n}", "Title": "kelp forest", "SearchableText": "kelp forest", "Description": "own"} for n in range(3)]
    index = build(books, settings)
    catalog = spark.createDataFrame([("/shelf/k0", 10, "from the catalog"), ("/shelf/k2", 12, None)], "path string, rid long, Description string")
    shown = {r["uid"]: r["row"] for r in index.search({"SearchableText": "kelp"}).rows(catalog).collect()}
    assert {r["Description"] for r in shown.values()} == {"<kelp> forest"}
    assert sorted(r["rid"] for r in shown.values()) == [-1, 10, 12]
    plain = {r["uid"]: r["row"]["Description"] for r in index.search({"Title": "kelp"}).rows(catalog).collect()}
    # without an extract the catalog's own, the index's where the catalog has no row
    assert plain == {"b00000": "from the catalog", "b00001": "own", "b00002": None}
    page = index.search({"SearchableText": "kelp", "sort_on": "getId"}).page_rows(1, catalog, 2).collect()
    assert [(r["place"], r["row"]["rid"]) for r in page] == [(1, -1), (2, 12)]


READERS = [["everyone"], ["staff"], ["everyone", "staff"], ["nobody"]]


def test_viewers(build):
    books = [
        {"id": f"r{n}-{k}", "Title": "ledger", "readers": readers, "effective": NOW + (k - 2) * DAY, "expires": NOW + (k - 1) * DAY}
        for n, readers in enumerate(READERS)
        for k in range(4)
    ]
    index = build(books)

    def right(who, active=True):
        return expected(books, lambda b: set(who) & set(b["readers"]) and (not active or b["effective"] <= NOW <= b["expires"]))

    query = {"SearchableText": "ledger"}
    assert ids(index.search(query)) == expected(books, lambda b: True)
    for who in ([], ["everyone"], ["everyone", "staff"]):
        assert ids(index.restricted_search(query, who, now=NOW)) == right(who)
        assert ids(index.restricted_search({**query, "show_inactive": True}, who, now=NOW)) == right(who, False)
        assert ids(index.restricted_search(query, who, now=NOW, sees_inactive=True)) == right(who, False)
    # the viewer's conditions replace what the caller asks for on the same keys
    asked = {**query, "allowedRolesAndUsers": ["nobody"], "effectiveRange": NOW - 400 * DAY}
    assert ids(index.restricted_search(asked, ["staff"], now=NOW)) == right(["staff"])
    # empty constraints are none
    assert ids(index.search({**query, "effectiveRange": None, "portal_type": []})) == expected(books, lambda b: True)


# --- plans and extension points ---


def test_filter_plan_reads_no_text(build):
    plan = build([{"Title": "x"}]).search({"portal_type": "Novel"}).fields()._jdf.queryExecution().toString()
    assert "regexp_extract_all" not in plan and "postings" not in plan


def test_row_factory(build):
    index = build([{"Title": "fern one"}, {"Title": "fern two"}])
    found = index.search({"Title": "fern"}, row_factory=lambda df: df.select("uid", F.upper("Title").alias("t")))
    assert sorted(r["t"] for r in found.hits.collect()) == ["FERN ONE", "FERN TWO"]
