"""Predicates: exact, negated, date, interval, path, viewer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from findlark import IndexSpec, Registry, Settings
from findlark.plans.search import SearchIndex
from findlark.workload import common as C

QUERIES = C.Catalogue()
query = QUERIES.add


def _content(spark, sf_dir, constraints):
    found = C.content_index(spark, sf_dir).search(constraints)
    return found.fields("portal_type", "Language").select(
        "uid", "portal_type", F.col("Language").alias("lang"), "score"
    )


def _content_sql(where, score="0.0"):
    return f"WITH {C.CONTENT_SQL} SELECT uid, portal_type, lang, CAST({score} AS DOUBLE) AS score FROM content WHERE {where}"


@query(_content_sql("portal_type = 'src3'"))
def term_filter(spark, sf_dir):
    return _content(spark, sf_dir, {"portal_type": "src3"})


@query(_content_sql("portal_type IN ('src1', 'src2', 'src11') AND lang IN ('en', 'fr')"))
def terms_any(spark, sf_dir):
    return _content(spark, sf_dir, {"portal_type": ["src1", "src2", "src11"], "Language": ("en", "fr")})


@query(_content_sql("lang IN ('de') OR portal_type IN ('src5')"))
def keywords_any(spark, sf_dir):
    return _content(spark, sf_dir, {"Subject": ["de", "src5"]})


@query(_content_sql("lang = 'de' AND portal_type = 'src5'"))
def keywords_all(spark, sf_dir):
    rows = C.content(spark, sf_dir)
    found = SearchIndex(rows, C.CONTENT, Settings(honour_operator=True)).search(
        {"Subject": {"query": ["de", "src5"], "operator": "and"}}
    )
    return found.fields("portal_type", "Language").select(
        "uid", "portal_type", F.col("Language").alias("lang"), "score"
    )


@query(_content_sql("lang <> 'en'"))
def not_term(spark, sf_dir):
    return _content(spark, sf_dir, {"Language": {"not": "en"}})


@query(_content_sql("lang NOT IN ('en', 'fr') AND portal_type NOT IN ('src1', 'src2')"))
def not_terms(spark, sf_dir):
    return _content(spark, sf_dir, {"Language": {"not": ["en", "fr"]}, "portal_type": {"not": ("src1", "src2")}})


@query(
    f"""WITH {C.CONTENT_SQL} SELECT uid, quality FROM content LEFT JOIN labels USING (doc_id)
    WHERE quality IS NULL OR quality <> 1"""
)
def not_term_missing(spark, sf_dir):
    found = SearchIndex(C.labelled(spark, sf_dir), C.CONTENT).search({"quality": {"not": 1}})
    return found.fields("quality").drop("score")


@query(_content_sql("true", "1.0"))
def empty_spec_noop(spark, sf_dir):
    return _content(spark, sf_dir, {"portal_type": "", "Language": None, "Subject": [], "path": ""})


@query(_content_sql("lang = 'fr'"))
def query_wrapper(spark, sf_dir):
    return _content(spark, sf_dir, {"Language": {"query": "fr", "operator": "and", "range": "min"}})


@query(_content_sql("true", "1.0"))
def match_all(spark, sf_dir):
    return _content(spark, sf_dir, {})


@query(_content_sql("lang = 'es'"))
def unknown_key(spark, sf_dir):
    return _content(spark, sf_dir, {"no_such_index": "x", "Language": "es", "b_size": 10, "sort_limit": 5})


@query(_content_sql("uid IN ('0', '17', '42', '99', '150')"))
def uid_lookup(spark, sf_dir):
    return _content(spark, sf_dir, {"UID": ["0", "17", "42", "99", "150"]})


@query(f"WITH {C.CONTENT_SQL} SELECT count(*) AS hits FROM content WHERE lang = 'de' AND portal_type <> 'src7'")
def hit_count(spark, sf_dir):
    found = C.content_index(spark, sf_dir).search({"Language": "de", "portal_type": {"not": "src7"}})
    return found.fields().agg(F.count("*").alias("hits"))


@query("SELECT CAST(doc_id AS VARCHAR) AS uid, toxic = 1 AS toxic FROM labels WHERE toxic = 0")
def bool_filter(spark, sf_dir):
    registry = Registry([IndexSpec("toxic", "boolean")])
    labels = C.table(spark, sf_dir, "labels")
    rows = labels.select(F.col("doc_id").cast("string").alias("uid"), F.col("toxic").cast("boolean").alias("toxic"))
    return SearchIndex(rows, registry).search({"toxic": False}).fields("toxic").drop("score")


@query("SELECT CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS uid, role FROM conversations WHERE turn = 2")
def position_term(spark, sf_dir):
    registry = Registry([IndexSpec("getObjPositionInParent", "position")])
    turns = C.table(spark, sf_dir, "conversations")
    rows = turns.select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("uid"),
        F.col("turn").cast("int").alias("getObjPositionInParent"),
        "role",
    )
    return SearchIndex(rows, registry).search({"getObjPositionInParent": 2}).fields("role").drop("score")


@query(
    r"""SELECT CAST(p_partkey AS VARCHAR) AS uid, p_name FROM part
    WHERE list_contains(regexp_extract_all(lower(p_name), '[\p{L}\p{N}_]+'), 'ring')"""
)
def analyzed_term(spark, sf_dir):
    registry = Registry([IndexSpec("p_name", "field")])
    parts = C.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("uid"), "p_name")
    return SearchIndex(parts, registry).search({"p_name": "ring"}).fields("p_name").drop("score")


# --- dates ---


def _orders(spark, sf_dir, constraints):
    found = SearchIndex(C.orders(spark, sf_dir), C.ORDERS).search(constraints)
    return found.fields("o_orderstatus", "o_totalprice").drop("score")


def _orders_sql(where):
    return f"SELECT CAST(o_orderkey AS VARCHAR) AS uid, o_orderstatus, o_totalprice FROM orders WHERE {where}"


@query(_orders_sql("o_orderdate >= TIMESTAMP '1998-06-01'"))
def date_min(spark, sf_dir):
    return _orders(spark, sf_dir, {"o_orderdate": {"query": "1998-06-01", "range": "min"}})


@query(_orders_sql("o_orderdate <= TIMESTAMP '1995-03-15'"))
def date_max(spark, sf_dir):
    when = [datetime(1995, 3, 15), datetime(1999, 1, 1)]
    return _orders(spark, sf_dir, {"o_orderdate": {"query": when, "range": "max"}})


@query(_orders_sql("o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'"))
def date_between(spark, sf_dir):
    span = ("1996/01/01", "1996/12/31")
    return _orders(spark, sf_dir, {"o_orderdate": {"query": span, "range": "min:max"}})


@query(_orders_sql("o_orderdate >= TIMESTAMP '1997-05-28' AND o_orderstatus = 'F'"))
def date_list_default(spark, sf_dir):
    return _orders(spark, sf_dir, {"o_orderdate": {"query": ["1997-05-28", "1990-01-01"]}, "o_orderstatus": "F"})


@query(_orders_sql("o_orderpriority = '1-URGENT'"))
def date_without_constraint(spark, sf_dir):
    when = {"query": ["1997-05-28"], "range": "minmax"}
    return _orders(spark, sf_dir, {"o_orderdate": when, "o_orderpriority": "1-URGENT"})


@query(
    f"""WITH {C.INTERVAL_SQL} SELECT CAST(o_orderkey AS VARCHAR) AS uid, o_orderpriority FROM spans
    WHERE o_orderdate <= TIMESTAMP '1998-06-01' AND until >= TIMESTAMP '1998-06-01'"""
)
def interval_contains(spark, sf_dir):
    rows = C.order_intervals(spark, sf_dir)
    found = SearchIndex(rows, C.ORDERS).search({"effectiveRange": datetime(1998, 6, 1)})
    return found.fields("o_orderpriority").drop("score")


# --- paths ---


def _tree(spark, sf_dir, spec, settings=None):
    found = SearchIndex(C.tree(spark, sf_dir), C.TREE, settings or Settings()).search({"path": spec})
    return found.fields().select("path")


def _tree_sql(where):
    return f"WITH {C.TREE_SQL} SELECT path FROM nodes WHERE {where}"


@query(_tree_sql("starts_with(path, '/AFRICA') AND depth >= 1"))
def path_subtree(spark, sf_dir):
    return _tree(spark, sf_dir, {"query": "/AFRICA", "depth": -1})


@query(
    f"""WITH {C.CONTENT_SQL} SELECT uid, path FROM content
    WHERE starts_with(path, '/docs/de') OR starts_with(path, '/docs/en/w')"""
)
def stored_subtree(spark, sf_dir):
    """Two subtrees of a stored index, one of them a textual prefix of folders' names."""
    found = C.content_store(spark, sf_dir).index().search({"path": ["/docs/de", "/docs/en/w"]})
    return found.fields().select("uid", "path")


@query(_tree_sql("starts_with(path, '/ASIA/NATION_2') AND depth >= 2"))
def path_prefix_is_textual(spark, sf_dir):
    return _tree(spark, sf_dir, "/ASIA/NATION_2")


@query(_tree_sql("(path = '/ASIA/NATION_2' OR starts_with(path, '/ASIA/NATION_2/')) AND depth >= 2"))
def path_strict_subtree(spark, sf_dir):
    return _tree(spark, sf_dir, "/ASIA/NATION_2", Settings(strict_subtree=True))


@query(_tree_sql("starts_with(path, '/EUROPE') AND depth > 1 AND depth <= 2"))
def path_children(spark, sf_dir):
    return _tree(spark, sf_dir, {"query": "/EUROPE", "depth": 1})


@query(_tree_sql("path = '/AMERICA/NATION_1'"))
def path_exact(spark, sf_dir):
    return _tree(spark, sf_dir, {"query": "/AMERICA/NATION_1", "depth": 0})


@query(_tree_sql("starts_with(path, '/ASIA') AND depth >= 2 AND depth <= 2"))
def path_navtree(spark, sf_dir):
    return _tree(spark, sf_dir, {"query": "/ASIA", "depth": 1, "navtree": True, "navtree_start": 1})


@query(_tree_sql("(starts_with(path, '/ASIA') AND depth > 1 AND depth <= 2) OR (starts_with(path, '/EUROPE') AND depth > 1 AND depth <= 2)"))
def path_multi(spark, sf_dir):
    return _tree(spark, sf_dir, {"query": ["/ASIA", "/EUROPE"], "depth": 1})


# --- viewers ---


@query(_orders_sql("o_orderstatus = 'P' OR o_orderpriority = '2-HIGH'"))
def principals_filter(spark, sf_dir):
    found = SearchIndex(C.orders(spark, sf_dir), C.ORDERS).restricted_search(
        {"show_inactive": True}, ["status:P", "priority:2-HIGH", "Anonymous"]
    )
    return found.fields("o_orderstatus", "o_totalprice").drop("score")


@query(
    f"""WITH {C.INTERVAL_SQL} SELECT CAST(o_orderkey AS VARCHAR) AS uid, o_orderpriority FROM spans
    WHERE (o_orderstatus = 'O' OR o_orderpriority = '5-LOW') AND o_orderstatus <> 'P'
      AND o_orderdate <= TIMESTAMP '1997-02-03 04:05:06' AND until >= TIMESTAMP '1997-02-03 04:05:06'"""
)
def restricted_search(spark, sf_dir):
    found = SearchIndex(C.order_intervals(spark, sf_dir), C.ORDERS).restricted_search(
        {"o_orderstatus": {"not": "P"}}, ["status:O", "priority:5-LOW"], now=datetime(1997, 2, 3, 4, 5, 6)
    )
    return found.fields("o_orderpriority").drop("score")


@query(
    f"""WITH {C.INTERVAL_SQL} SELECT CAST(o_orderkey AS VARCHAR) AS uid, o_orderpriority FROM spans
    WHERE o_orderstatus <> 'P'"""
)
def unrestricted_search(spark, sf_dir):
    found = SearchIndex(C.order_intervals(spark, sf_dir), C.ORDERS).search({"o_orderstatus": {"not": "P"}})
    return found.fields("o_orderpriority").drop("score")
