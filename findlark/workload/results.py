"""Sorting, paging, catalog rows, reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from findlark import IndexSpec, Registry
from findlark.functions.values import size_mb
from findlark.operators import ordering, reconcile
from findlark.operators.catalogjoin import join_catalog
from findlark.plans import jobs
from findlark.plans.search import SearchIndex
from findlark.sources import records
from findlark.workload import common as C
from findlark.workload.textsql import search_sql

QUERIES = C.Catalogue()
query = QUERIES.add


# --- order and pages ---


def _orders(spark, sf_dir, constraints):
    return SearchIndex(C.orders(spark, sf_dir), C.ORDERS).search(constraints)


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS uid, o_orderpriority,
    row_number() OVER (ORDER BY o_orderpriority DESC, o_orderdate DESC, CAST(o_orderkey AS VARCHAR)) - 1 AS place
    FROM orders"""
)
def sort_multi(spark, sf_dir):
    found = _orders(spark, sf_dir, {"sort_on": "o_orderpriority,o_orderdate", "sort_order": "reverse"})
    return found.ranked().select("uid", "o_orderpriority", F.col("rank").alias("place"))


@query(
    f"""WITH {C.CONTENT_SQL} SELECT uid, quality,
    row_number() OVER (ORDER BY quality DESC NULLS LAST, uid) - 1 AS place
    FROM content LEFT JOIN labels USING (doc_id)"""
)
def sort_desc_nulls(spark, sf_dir):
    found = SearchIndex(C.labelled(spark, sf_dir), C.CONTENT).search({"sort_on": "quality", "sort_order": "descending"})
    return found.ranked().select("uid", "quality", F.col("rank").alias("place"))


@query(
    search_sql(
        C.CONTENT_SQL,
        {"Body": "searchable"},
        [("phrase", "Body", ["que", "les"]), ("any", "Body", ["que", "les"])],
        "SELECT uid, round(score, 4) AS score FROM hits ORDER BY hits.score DESC, uid LIMIT 50",
    )
)
def relevance_default(spark, sf_dir):
    found = C.content_index(spark, sf_dir).search({"Body": "que les", "b_start": 3})
    return found.page(0).select("uid", F.round("score", 4).alias("score"))


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS uid, o_totalprice FROM orders WHERE o_orderstatus = 'O'
    ORDER BY o_totalprice, uid LIMIT 50 OFFSET 150"""
)
def page_offset(spark, sf_dir):
    found = _orders(spark, sf_dir, {"o_orderstatus": "O", "sort_on": "o_totalprice", "sort_order": "asc"})
    return found.page(150, 50).select("uid", "o_totalprice")


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS uid, o_totalprice FROM orders WHERE o_orderstatus = 'O'
    ORDER BY o_totalprice, uid LIMIT 50 OFFSET 500"""
)
def page_deep(spark, sf_dir):
    found = _orders(spark, sf_dir, {"o_orderstatus": "O", "sort_on": "o_totalprice"})
    return found.deep_page(500, 50).select("uid", "o_totalprice")


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS uid,
    row_number() OVER (ORDER BY o_orderdate, CAST(o_orderkey AS VARCHAR)) - 1 - count(*) OVER () AS from_end
    FROM orders WHERE o_orderstatus = 'F'"""
)
def negative_access(spark, sf_dir):
    found = _orders(spark, sf_dir, {"o_orderstatus": "F", "sort_on": "o_orderdate"})
    places = found.ranked()
    total = places.agg(F.count("*").alias("n")).scalar()
    return places.select("uid", (F.col("rank") - total).alias("from_end"))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS uid,
    (row_number() OVER (ORDER BY n_chars, CAST(doc_id AS VARCHAR)) - 1) // 50 AS batch FROM documents"""
)
def batch_numbers(spark, sf_dir):
    found = C.content_index(spark, sf_dir).search({"sort_on": "n_chars"})
    return ordering.with_batches(found.ranked(), 50).select("uid", "batch")


# --- ids and records ---


@query("SELECT CAST(doc_id AS VARCHAR) AS uid FROM documents")
def all_ids(spark, sf_dir):
    return records.index_ids(C.content(spark, sf_dir))


@query("SELECT DISTINCT CAST(user_id AS VARCHAR) AS uid FROM events")
def catalog_ids(spark, sf_dir):
    rows = C.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("uid"))
    return records.unique_values(rows, "uid")


@query(f"WITH {C.TREE_SQL} SELECT path, depth FROM nodes WHERE path = '/ASIA/NATION_2'")
def record_by_path(spark, sf_dir):
    found = records.record_by_path(C.tree(spark, sf_dir), "/ASIA/NATION_2")
    return found.select(F.col("path.path").alias("path"), F.col("path.depth").cast("long").alias("depth"))


@query(
    f"""WITH {C.CONTENT_SQL}, wanted AS (SELECT path FROM content UNION ALL SELECT path || '/gone' FROM content)
    SELECT w.path, c.uid, c.n_chars FROM wanted w LEFT JOIN content c ON c.path = w.path"""
)
def rows_by_path(spark, sf_dir):
    rows = C.content(spark, sf_dir).select("uid", "path", "n_chars")
    known = rows.select(F.col("path.path").alias("path"))
    gone = known.select(F.concat("path", F.lit("/gone")).alias("path"))
    return records.records_by_paths(rows, known.unionByName(gone)).select("path", "uid", "n_chars")


@query(
    f"""WITH {C.CONTENT_SQL}, catalog AS (SELECT path, quality FROM content JOIN labels USING (doc_id))
    SELECT c.path, k.quality FROM content c LEFT JOIN catalog k ON k.path = c.path"""
)
def catalog_by_path(spark, sf_dir):
    labelled = C.labelled(spark, sf_dir)
    catalog = labelled.where(F.col("quality").isNotNull()).select(F.col("path.path").alias("path"), "quality")
    paths = C.content(spark, sf_dir).select(F.col("path.path").alias("path"))
    return records.catalog_by_paths(catalog, paths)


# --- hits with catalog rows ---


def _catalog(spark, sf_dir):
    """Labelled documents are the catalog: rid and title by path."""
    labelled = C.labelled(spark, sf_dir).where(F.col("quality").isNotNull())
    return labelled.select(
        F.col("path.path").alias("path"), F.col("uid").cast("long").alias("rid"), F.col("Title"), "quality"
    )


@query(
    f"""WITH {C.CONTENT_SQL} SELECT c.uid, c.path, coalesce(l.doc_id, -1) AS rid, c.title, l.quality
    FROM content c LEFT JOIN labels l USING (doc_id) WHERE lang <> 'en'"""
)
def hits_fallback_record(spark, sf_dir):
    rows = C.content(spark, sf_dir)
    found = SearchIndex(rows, C.CONTENT).search({"Language": {"not": "en"}})
    joined = found.rows(_catalog(spark, sf_dir))
    return joined.select("uid", "path", "row.rid", F.col("row.Title").alias("title"), "row.quality")


@query(
    search_sql(
        C.CONTENT_SQL,
        {"Title": "title"},
        [("phrase", "Title", ["the"]), ("prefix", "Title", ["the"], 2.0)],
        """SELECT uid, coalesce(l.doc_id, -1) AS rid, round(score, 4) AS score
        FROM hits JOIN content USING (uid) LEFT JOIN labels l USING (doc_id)""",
    )
)
def hits_catalog_left(spark, sf_dir):
    rows = C.content(spark, sf_dir)
    found = SearchIndex(rows, C.CONTENT).search({"Title": "the"})
    joined = found.rows(_catalog(spark, sf_dir))
    return joined.select("uid", "row.rid", F.round("score", 4).alias("score"))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS uid, CASE WHEN lang <> 'en' THEN coalesce(l.doc_id, -1) END AS rid
    FROM documents LEFT JOIN labels l USING (doc_id)"""
)
def hits_without_path(spark, sf_dir):
    rows = C.content(spark, sf_dir)
    hits = rows.select("uid", F.when(F.col("Language") != "en", F.col("path.path")).alias("path"))
    stored = rows.select(F.col("path.path").alias("path"))
    return join_catalog(hits, _catalog(spark, sf_dir), stored).select("uid", "row.rid")


# --- reconciliation: documents are the catalog, labels the index; ids shifted for orphans ---

_SIDES = """catalog AS (SELECT CAST(doc_id AS VARCHAR) AS uid, n_chars FROM documents),
idx AS (SELECT CAST(doc_id + 7 AS VARCHAR) AS uid, -1 AS n_chars FROM labels
        UNION ALL SELECT 'x' || CAST(doc_id AS VARCHAR), -1 FROM labels WHERE toxic = 1)"""


def _sides(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    catalog = docs.select(F.col("doc_id").cast("string").alias("uid"), "n_chars")
    labels = C.table(spark, sf_dir, "labels")
    shifted = labels.select((F.col("doc_id") + 7).cast("string").alias("uid"), F.lit(-1).cast("long").alias("n_chars"))
    extra = labels.where("toxic = 1").select(
        F.concat(F.lit("x"), F.col("doc_id").cast("string")).alias("uid"), F.lit(-1).cast("long").alias("n_chars")
    )
    return catalog, shifted.unionByName(extra)


@query(f"WITH {_SIDES} SELECT uid FROM catalog WHERE uid NOT IN (SELECT uid FROM idx)")
def sync_missing(spark, sf_dir):
    return reconcile.not_indexed(*_sides(spark, sf_dir))


@query(f"WITH {_SIDES} SELECT uid FROM idx WHERE uid NOT IN (SELECT uid FROM catalog)")
def sync_orphans(spark, sf_dir):
    return reconcile.orphaned(*_sides(spark, sf_dir))


@query(
    f"""WITH {_SIDES} SELECT uid, n_chars FROM idx WHERE uid IN (SELECT uid FROM catalog)
    UNION ALL SELECT uid, n_chars FROM catalog WHERE uid NOT IN (SELECT uid FROM idx)"""
)
def synchronize(spark, sf_dir):
    catalog, rows = _sides(spark, sf_dir)
    return reconcile.synchronized(catalog, rows, catalog)


@query(
    f"""WITH {_SIDES} SELECT
    (SELECT count(*) FROM catalog WHERE uid NOT IN (SELECT uid FROM idx)) AS indexed,
    (SELECT count(*) FROM idx WHERE uid NOT IN (SELECT uid FROM catalog)) AS deleted"""
)
def sync_totals(spark, sf_dir):
    return reconcile.sync_totals(*_sides(spark, sf_dir))


@query(
    f"""WITH {_SIDES} SELECT * FROM (SELECT (SELECT count(*) FROM catalog) AS catalog_docs,
    (SELECT count(*) FROM idx) AS index_docs) WHERE catalog_docs <> index_docs"""
)
def drift_report(spark, sf_dir):
    return reconcile.drift_report(*_sides(spark, sf_dir))


@query(
    f"""WITH {_SIDES} SELECT (SELECT count(*) FROM catalog) AS catalog_docs,
    (SELECT count(*) FROM idx) AS index_docs,
    (SELECT count(*) FROM events WHERE event_type = 'error') AS deleted_docs,
    (SELECT CAST(CAST(ceil(sum(n_chars) / 1024 / 1024) AS BIGINT) AS VARCHAR) || ' MB' FROM documents) AS size,
    (SELECT count(*) FROM events WHERE event_type = 'view') AS query_count"""
)
def info_stats(spark, sf_dir):
    """Statistics over a commit log; events and document sizes stand in for its rows."""
    catalog, rows = _sides(spark, sf_dir)
    events = C.table(spark, sf_dir, "events").select(
        (F.col("event_type") == "error").cast("long").alias("deleted"),
        F.lit(0).cast("long").alias("bytes"),
        (F.col("event_type") == "view").cast("long").alias("queries"),
    )
    sizes = catalog.select(F.lit(0).cast("long").alias("deleted"), F.col("n_chars").alias("bytes"), F.lit(0).cast("long").alias("queries"))
    return reconcile.index_info(catalog, rows, events.unionByName(sizes))


@query("SELECT CAST(CAST(ceil(n_chars / 1024 / 1024) AS BIGINT) AS VARCHAR) || ' MB' AS size, count(*) AS docs FROM documents GROUP BY 1")
def size_labels(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    return docs.groupBy(size_mb(F.col("n_chars")).alias("size")).agg(F.count("*").alias("docs"))


@query(
    f"""WITH {C.TREE_SQL}, wanted AS (SELECT path FROM tree WHERE path LIKE '%5'
      UNION ALL SELECT path || '/unknown' FROM tree)
    SELECT path AS uid FROM tree WHERE path IN (SELECT path FROM wanted)"""
)
def uncatalog_paths(spark, sf_dir):
    paths = C.tree_paths(spark, sf_dir)
    catalog = paths.select(F.col("path").alias("uid"), "path")
    wanted = paths.where(F.col("path").endswith("5")).unionByName(
        paths.select(F.concat("path", F.lit("/unknown")).alias("path"))
    )
    return reconcile.uncataloged_ids(catalog, wanted)


_PATHS = Registry([IndexSpec("path", "path")])


@query(f"WITH {C.TREE_SQL} SELECT path FROM tree WHERE NOT path LIKE '%5'")
def uncatalog_stored(spark, sf_dir):
    """The same deletes applied to a stored index."""
    rows = C.tree(spark, sf_dir)
    store = C.new_store(spark, _PATHS)
    store.rebuild(rows)
    catalog = rows.select("uid", F.col("path.path").alias("path"))
    jobs.uncatalog(store, catalog, catalog.where(F.col("path").endswith("5")).select("path"))
    return store.rows().select(F.col("path.path").alias("path"))
