"""Driver tables adapted to content, tree, catalog and feed, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark import IndexSpec, Registry, Settings
from findlark.config import fresh_path
from findlark.functions.values import path_struct
from findlark.plans.search import SearchIndex
from findlark.plans.store import IndexStore


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


class Catalogue(dict):
    """Name to :class:`Entry`, filled by decorating the query functions."""

    def add(self, sql: str | None = None):
        def keep(run):
            self[run.__name__] = Entry(run, sql.strip() if sql else None)
            return run

        return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- documents ---

CONTENT = Registry(
    [
        IndexSpec("UID", "uuid"),
        IndexSpec("SearchableText", "text"),
        IndexSpec("Title", "text"),
        IndexSpec("Body", "text"),
        IndexSpec("portal_type", "field"),
        IndexSpec("Language", "field", analyzed=False),
        IndexSpec("Subject", "keyword", many=True),
        IndexSpec("n_chars", "field", dtype=T.LongType()),
        IndexSpec("quality", "field", dtype=T.IntegerType()),
        IndexSpec("path", "path"),
    ]
)

CONTENT_SQL = """content AS (
  SELECT CAST(doc_id AS VARCHAR) AS uid, text AS searchable, split_part(text, '.', 1) AS title,
         source AS portal_type, lang, n_chars, doc_id,
         '/docs/' || lang || '/' || source || '/' || CAST(doc_id AS VARCHAR) AS path
  FROM documents)"""


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as index rows."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.lit("/docs"), "lang", "source", F.col("doc_id").cast("string"))
    return docs.select(
        F.col("doc_id").cast("string").alias("uid"),
        F.col("text").alias("SearchableText"),
        F.substring_index("text", ".", 1).alias("Title"),
        F.col("text").alias("Body"),
        F.col("source").alias("portal_type"),
        F.col("lang").alias("Language"),
        F.array("lang", "source").alias("Subject"),
        "n_chars",
        path_struct(path).alias("path"),
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content with its quality label, null where there is none."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("uid"), "quality", "toxic")
    return content(spark, sf_dir).join(labels, "uid", "left")


def spread(spark: SparkSession, settings: Settings | None = None) -> Settings:
    """Settings for the driver's tables: each is one file, so texts are spread over the cores."""
    return replace(settings or Settings(), scan_partitions=spark.sparkContext.defaultParallelism)


def content_index(spark: SparkSession, sf_dir: str, settings: Settings | None = None) -> SearchIndex:
    return SearchIndex(content(spark, sf_dir), CONTENT, spread(spark, settings))


STORED = Registry(
    [
        IndexSpec("SearchableText", "text"),
        IndexSpec("Title", "text"),
        IndexSpec("portal_type", "field"),
        IndexSpec("Language", "field", analyzed=False),
        IndexSpec("n_chars", "field", dtype=T.LongType()),
        IndexSpec("path", "path"),
    ]
)

_stores: dict[tuple[str, str], IndexStore] = {}


def new_store(spark: SparkSession, registry: Registry, settings: Settings | None = None) -> IndexStore:
    settings = settings or Settings(buckets=8, search_only=frozenset(), retries=0)
    return IndexStore(spark, fresh_path(spark, "store"), registry, settings, site="/Docs")


def content_store(spark: SparkSession, sf_dir: str) -> IndexStore:
    """The documents as a stored index, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        store = new_store(spark, STORED)
        store.rebuild(content(spark, sf_dir))
        _stores[key] = store
    return _stores[key]


# --- region, nation, customer as a folder tree ---

TREE = Registry([IndexSpec("path", "path")])

TREE_SQL = """tree AS (
  SELECT '/' || r_name AS path FROM region
  UNION ALL
  SELECT '/' || r_name || '/' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT '/' || r_name || '/' || n_name || '/' || c_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
nodes AS (SELECT path, length(path) - length(replace(path, '/', '')) AS depth FROM tree)"""


def tree_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select("r_regionkey", F.concat(F.lit("/"), "r_name").alias("r"))
    nation = table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    nation = nation.select("n_nationkey", F.concat_ws("/", "r", "n_name").alias("n"))
    customer = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    customer = customer.select(F.concat_ws("/", "n", "c_name").alias("path"))
    paths = region.select(F.col("r").alias("path")).unionByName(nation.select(F.col("n").alias("path")))
    return paths.unionByName(customer)


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tree_paths(spark, sf_dir)
    return paths.select(F.col("path").alias("uid"), path_struct(F.col("path")).alias("path"))


# --- orders with interval and viewers ---

ORDERS = Registry(
    [
        IndexSpec("o_orderdate", "date"),
        IndexSpec("o_orderpriority", "field", analyzed=False),
        IndexSpec("o_orderstatus", "field", analyzed=False),
        IndexSpec("allowedRolesAndUsers", "keyword", many=True),
        IndexSpec("effectiveRange", "daterange"),
    ]
)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    viewers = F.array(
        F.concat(F.lit("status:"), "o_orderstatus"), F.concat(F.lit("priority:"), "o_orderpriority")
    )
    return rows.select(
        F.col("o_orderkey").cast("string").alias("uid"), "*", viewers.alias("allowedRolesAndUsers")
    )


def order_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in effect from their date to their last shipment."""
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("until"))
    rows = orders(spark, sf_dir).join(shipped, F.col("o_orderkey") == F.col("l_orderkey"))
    return rows.withColumn("effectiveRange", F.struct(F.col("o_orderdate").alias("since"), "until"))


INTERVAL_SQL = """spans AS (
  SELECT o.*, s.until FROM orders o
  JOIN (SELECT l_orderkey, max(l_shipdate) AS until FROM lineitem GROUP BY 1) s ON o_orderkey = l_orderkey)"""
