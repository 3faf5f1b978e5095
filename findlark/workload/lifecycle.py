"""Stores over their life: moves, two feeds at once, failures, access to results, missing fields."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from findlark import IndexSpec, Registry, Settings
from findlark.config import fresh_path
from findlark.operators import changes
from findlark.operators.highlight import highlight_fragments
from findlark.operators.positions import changed_positions, move_members
from findlark.operators.textmatch import Clause, highlight_words
from findlark.plans.search import SearchIndex
from findlark.streaming.feed import commit_batch, drain, follow_blobs, follow_feed
from findlark.workload import common as C
from findlark.workload import text as X
from findlark.workload import upkeep as U
from findlark.workload.textsql import search_sql

QUERIES = C.Catalogue()
query = QUERIES.add

# --- moves, committed ---

TURNS = Registry([IndexSpec("role", "field", analyzed=False), IndexSpec("getObjPositionInParent", "position")])


@query(
    f"""WITH {U._TURNS}, n AS (SELECT *, max(position) OVER (PARTITION BY conv_id) AS last FROM turns)
    SELECT CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS uid, role,
      CASE WHEN last = 0 THEN 0 WHEN position = 0 THEN least(2, last)
           WHEN position <= least(2, last) THEN position - 1 ELSE position END AS position FROM n"""
)
def position_commit(spark, sf_dir):
    """The first turn of every conversation moved down by two, applied to a stored index.

    Actions carry the position alone; those of turns the index does not hold are refused.
    """
    placed = U._positions(spark, sf_dir)
    uid = F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("uid")
    store = C.new_store(spark, TURNS)
    store.rebuild(placed.select(uid, "role", F.col("position").alias("getObjPositionInParent")))
    first = placed.where("position = 0").select("conv_id", "turn", F.lit(2).alias("delta"))
    changed = changed_positions(move_members(placed, first, "conv_id", "turn"))
    position = F.col("position_after").alias("getObjPositionInParent")
    rows = changed.select(uid, position)
    unknown = changed.select(F.concat_ws("/", F.col("conv_id").cast("string"), F.lit("gone")).alias("uid"), position)
    feed = changes.feed_rows(
        rows.unionByName(unknown.dropDuplicates(["uid"])), "reindex", F.lit(1).cast("long"), ["getObjPositionInParent"]
    )
    commit_batch(store, feed)
    return store.rows().select("uid", "role", F.col("getObjPositionInParent").cast("long").alias("position"))


# --- two feeds ---

_FILES_SQL = f"""SELECT CAST(doc_id AS VARCHAR) AS uid, coalesce('toxic ' || CAST(toxic AS VARCHAR), source) AS portal_type,
    md5(text || coalesce({U.HTML_TEXT_SQL}, '')) AS digest, page_id IS NOT NULL AS has_file
    FROM documents LEFT JOIN labels USING (doc_id) LEFT JOIN pages ON page_id = doc_id"""
FILED = Registry([IndexSpec("SearchableText", "text"), IndexSpec("portal_type", "field", analyzed=False)])


def _stream(spark, sf_dir, name):
    schema = C.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _files(spark, sf_dir):
    return _stream(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("uid"), F.lit("file").alias("fieldname"),
        F.lit("page.html").alias("filename"), F.encode("html", "UTF-8").alias("data"),
    )


def _filed(store):
    return store.rows().select(
        "uid", "portal_type", F.md5(F.encode("SearchableText", "UTF-8")).alias("digest"),
        F.col("attachments").isNotNull().alias("has_file"),
    )


@query(_FILES_SQL)
def two_feeds_commit(spark, sf_dir):
    """Changes and attachments taken in side by side: two writers on one store."""
    store = C.new_store(spark, FILED)
    store.rebuild(C.content(spark, sf_dir))
    labels = _stream(spark, sf_dir, "labels")
    told = F.concat(F.lit("toxic "), F.col("toxic").cast("string")).alias("portal_type")
    feed = changes.feed_rows(
        labels.select(F.col("doc_id").cast("string").alias("uid"), told), "reindex", F.lit(1).cast("long"), ["portal_type"]
    )
    progress = fresh_path(spark, "progress")
    streams = [follow_feed(store, feed, f"{progress}/a"), follow_blobs(store, _files(spark, sf_dir), f"{progress}/b")]
    for stream in streams:
        stream.awaitTermination()
    return _filed(store)


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS uid, source AS portal_type, md5(text || coalesce({U.HTML_TEXT_SQL}, '')) AS digest,
    page_id IS NOT NULL AS has_file FROM documents LEFT JOIN pages ON page_id = doc_id"""
)
def drain_order(spark, sf_dir):
    """Changes before attachments: only so do the files meet the documents they belong to."""
    store = C.new_store(spark, FILED)
    store.convert()
    docs = _stream(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("uid"), F.col("text").alias("SearchableText"), F.col("source").alias("portal_type")
    )
    feed = changes.feed_rows(docs, "index", F.lit(1).cast("long"))
    drain(store, feed, _files(spark, sf_dir), fresh_path(spark, "progress"))
    return _filed(store)


# --- failures ---


def _names_only(events):
    return U.feed(events).withColumn(
        "payload", F.lit(None).cast("struct<value:double,props:string,last_type:string>")
    )


def _failing_at_first(spark, sf_dir, times):
    """Current values that cannot be read the first ``times`` times."""
    left = [times]

    def current():
        if left[0]:
            left[0] -= 1
            raise RuntimeError("the content is out of reach")
        return C.table(spark, sf_dir, "customer").select(
            F.col("c_custkey").cast("string").alias("uid"), F.col("c_acctbal").alias("value"),
            F.col("c_name").alias("props"), F.col("c_mktsegment").alias("last_type"),
        )

    return current


_HYDRATED = U.QUERIES["stream_hydrate"].sql


@query(_HYDRATED)
def stream_retry(spark, sf_dir):
    """A batch whose values cannot be read at first is tried again and applied once."""
    store = U._account_store(spark, sf_dir, deferred=True, retries=2)
    U._follow(spark, sf_dir, store, _names_only, current=_failing_at_first(spark, sf_dir, 2))
    return store.rows().drop("attachments")


@query(_HYDRATED)
def stream_abort_replay(spark, sf_dir):
    """A batch that fails for good leaves nothing behind; started again, the stream replays it."""
    store = U._account_store(spark, sf_dir, deferred=True, retries=0)
    before = store.current()
    path, progress = fresh_path(spark, "events"), fresh_path(spark, "progress")
    events = C.table(spark, sf_dir, "events")
    events.write.parquet(path)
    feed = _names_only(spark.readStream.schema(events.schema).parquet(path))
    current = _failing_at_first(spark, sf_dir, 1)
    try:
        follow_feed(store, feed, progress, current=current).awaitTermination()
    except StreamingQueryException:
        assert store.current() == before
    follow_feed(store, feed, progress, current=current).awaitTermination()
    return store.rows().drop("attachments")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS uid, s_acctbal AS value, s_name AS props, 'supplier' AS last_type FROM supplier")
def inactive_store(spark, sf_dir):
    """Changes are ignored while the index is not enabled."""
    store = U._account_store(spark, sf_dir)
    off = type(store)(spark, store.path.rsplit("/", 1)[0], store.registry, Settings(enabled=False, search_only=frozenset()), site="/Docs")
    commit_batch(off, U.feed(C.table(spark, sf_dir, "events")))
    return store.rows().drop("attachments")


@query(
    """SELECT * FROM (VALUES (1, 'empty'), (3, 'empty')) v(version, step), (SELECT 0 AS docs) d
    UNION ALL SELECT 2, 'indexed', count(*) FROM documents"""
)
def clear_and_convert(spark, sf_dir):
    """Cleared before it was converted, converted (which changes nothing any more), filled, dropped."""
    store = C.new_store(spark, C.STORED)
    store.clear()
    store.convert()
    store.clear()
    store.commit(changes.full_indexes(C.content(spark, sf_dir).select("uid", *C.STORED)))
    store.recreate()
    step = F.when(F.col("indexed") > 0, "indexed").otherwise("empty").alias("step")
    return store.versions().select(F.col("version").cast("int").alias("version"), step, F.col("indexed").alias("docs"))


# --- access to results ---


@query(
    """WITH r AS (SELECT CAST(o_orderkey AS VARCHAR) AS uid, count(*) OVER () AS n,
      row_number() OVER (ORDER BY o_totalprice, CAST(o_orderkey AS VARCHAR)) - 1 AS place FROM orders WHERE o_orderstatus = 'O')
    SELECT 'first' AS what, uid FROM r WHERE place = 0 UNION ALL SELECT 'last', uid FROM r WHERE place = n - 1
    UNION ALL SELECT 'from the end', uid FROM r WHERE place = n - 77 UNION ALL SELECT 'third page', uid FROM r WHERE place = 120
    UNION ALL SELECT 'slice', uid FROM r WHERE place BETWEEN 20 AND 129
    UNION ALL SELECT 'steps', uid FROM r WHERE place >= n - 60 AND (n - 1 - place) % 7 = 0"""
)
def result_access(spark, sf_dir):
    """Places from both ends, and slices."""
    found = SearchIndex(C.orders(spark, sf_dir), C.ORDERS).search({"o_orderstatus": "O", "sort_on": "o_totalprice"})
    single = {"first": 0, "last": -1, "from the end": -77, "third page": 120}
    rows = spark.createDataFrame([(what, found[place]["uid"]) for what, place in single.items()], "what string, uid string")
    for what, part in (("slice", slice(20, 130)), ("steps", slice(-1, -61, -7))):
        rows = rows.unionByName(found[part].select(F.lit(what).alias("what"), "uid"))
    return rows


@query(
    search_sql(
        C.CONTENT_SQL,
        X.MAIN,
        X._main(["that", "with", "from"]),
        "SELECT uid, portal_type, round(score, 4) AS score FROM hits JOIN content USING (uid) ORDER BY hits.score DESC, uid LIMIT 20",
    )
)
def stored_top20(spark, sf_dir):
    """The best twenty of a search on a stored index."""
    found = C.content_store(spark, sf_dir).index().search({"SearchableText": "that with from"})
    return found.page(0, 20).select("uid", "portal_type", F.round("score", 4).alias("score"))


@query(
    search_sql(
        C.CONTENT_SQL,
        X.MAIN,
        X._main(["und", "der", "die"]),
        "SELECT uid, portal_type, round(score, 4) AS score FROM hits JOIN content USING (uid) "
        "WHERE lang = 'de' ORDER BY hits.score DESC, uid LIMIT 10 OFFSET 15",
    )
)
def stored_page(spark, sf_dir):
    """Rows 15 to 24 of a filtered search on a stored index, in order of relevance."""
    found = C.content_store(spark, sf_dir).index().search({"SearchableText": "und der die", "Language": "de"})
    return found.page(15, 10).select("uid", "portal_type", F.round("score", 4).alias("score"))


# --- fields, extracts, viewers ---


@query(
    search_sql(
        X._PARTS,
        {"SearchableText": "searchable"},
        [("phrase", "SearchableText", ["red", "widget"]), ("any", "SearchableText", ["red", "widget"])],
        "SELECT uid, kind, round(score, 4) AS score FROM hits, (VALUES ('scanned'), ('stored')) v(kind)",
    )
)
def search_without_title(spark, sf_dir):
    """The main text also asks for the title; rows without one are searched all the same."""
    registry = Registry([IndexSpec("SearchableText", "text")])
    rows = C.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("uid"), F.col("p_name").alias("SearchableText"))
    store = C.new_store(spark, registry)
    store.rebuild(rows)
    found = None
    for kind, index in (("scanned", SearchIndex(rows, registry)), ("stored", store.index())):
        hits = index.search({"SearchableText": "red widget"}).hits
        hits = hits.select("uid", F.lit(kind).alias("kind"), F.round("score", 4).alias("score"))
        found = hits if found is None else found.unionByName(hits)
    return found


@query(f"WITH {C.CONTENT_SQL},\n{X._FRAGMENTS} SELECT uid, ord, matches, fragment FROM best WHERE place <= 12")
def highlight_all_fragments(spark, sf_dir):
    """As ``highlight_best_fragments``, with another number of fragments."""
    clauses = [Clause("any", "SearchableText", ("that", "with"))]
    found = highlight_fragments(F.col("SearchableText"), highlight_words(clauses), "<em>", "</em>", 12)
    best = C.content(spark, sf_dir).select("uid", F.inline(found).alias("ord", "matches", "fragment"))
    return best.withColumns({name: F.col(name).cast("long") for name in ("ord", "matches")})


@query(
    search_sql(
        C.CONTENT_SQL,
        X.MAIN,
        X._main(["that", "with"]),
        """SELECT h.uid, coalesce(l.doc_id, -1) AS rid,
          coalesce(d.description, CASE WHEN l.doc_id IS NULL THEN 'of the index' ELSE 'of the catalog' END) AS description
        FROM hits h JOIN content c ON c.uid = h.uid LEFT JOIN described d ON d.uid = h.uid
        LEFT JOIN labels l ON l.doc_id = c.doc_id WHERE lang <> 'de'""",
        tail=f""",
{X._FRAGMENTS},
running AS (
  SELECT *, sum(length(fragment)) OVER (PARTITION BY uid ORDER BY place) AS total FROM best WHERE place <= 5),
described AS (
  SELECT uid, string_agg(fragment, ' ... ' ORDER BY place) AS description
  FROM running WHERE place = 1 OR total <= 250 GROUP BY uid)""",
    )
)
def hits_highlighted_row(spark, sf_dir):
    """Rows handed to the user show the extract, and the catalog's own text where there is none."""
    settings = Settings(highlight=True, highlight_threshold=250, highlight_pre_tags="<em>", highlight_post_tags="</em>")
    rows = C.content(spark, sf_dir).withColumn("Description", F.lit("of the index"))
    labels = C.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("uid"))
    catalog = rows.join(labels, "uid").select(
        F.col("path.path").alias("path"), F.col("uid").cast("long").alias("rid"), F.lit("of the catalog").alias("Description")
    )
    index = SearchIndex(rows, C.CONTENT, C.spread(spark, settings))
    joined = index.search({"SearchableText": "that with", "Language": {"not": "de"}}).rows(catalog)
    return joined.select("uid", "row.rid", F.col("row.Description").alias("description"))


@query(
    f"""WITH {C.INTERVAL_SQL} SELECT CAST(o_orderkey AS VARCHAR) AS uid FROM spans WHERE o_orderstatus = 'O'
      AND o_orderdate <= TIMESTAMP '1997-02-03 00:00:00' AND until >= TIMESTAMP '1997-02-03 00:00:00'"""
)
def restricted_overrides(spark, sf_dir):
    """The viewer's conditions take the place of the caller's on the same keys."""
    asked = {"allowedRolesAndUsers": ["status:F"], "effectiveRange": datetime(1993, 1, 1)}
    index = SearchIndex(C.order_intervals(spark, sf_dir), C.ORDERS)
    return index.restricted_search(asked, ["status:O"], now=datetime(1997, 2, 3)).hits.select("uid")
