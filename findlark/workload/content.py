"""Extraction, providers, schema, custom assembly, attachments."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark import IndexSpec, Registry, Settings
from findlark.functions import values as V
from findlark.functions.text import trim_stars
from findlark.operators import attachments as A
from findlark.plans.query import CompiledQuery, compile_query
from findlark.plans.search import SearchIndex
from findlark.config import fresh_path, full_uri
from findlark.sources.blobs import blob_fields, read_blobs, write_blobs
from findlark.sources.content import derive_rows, read_back
from findlark.workload import common as C
from findlark.workload.upkeep import HTML_TEXT_SQL

QUERIES = C.Catalogue()
query = QUERIES.add

# --- index rows of orders, one index of every kind ---

EXTRACTED = Registry(
    [
        IndexSpec("UID", "uuid"),
        IndexSpec("portal_type", "field", sources=("o_orderstatus",)),
        IndexSpec("Subject", "keyword", sources=("tags",), many=True),
        IndexSpec("Title", "text", sources=("o_orderpriority",)),
        IndexSpec("SearchableText", "text", sources=("blank", "o_orderpriority", "tags", "o_custkey")),
        IndexSpec("created", "date", sources=("created_text",)),
        IndexSpec("start", "recurring", sources=("occurrences",)),
        IndexSpec("effectiveRange", "daterange", sources=("o_orderdate", "expires")),
        IndexSpec("is_open", "boolean", sources=("open_text",)),
        IndexSpec("path", "path", sources=("segments",)),
        IndexSpec("getObjPositionInParent", "position", sources=("o_custkey",)),
    ]
)


def _source(spark, sf_dir):
    """Orders as content objects, with empty, missing and odd values among them."""
    key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return C.table(spark, sf_dir, "orders").select(
        key.cast("string").alias("uid"),
        "o_orderkey",
        "o_custkey",
        F.when(status == "P", "None").otherwise(status).alias("o_orderstatus"),
        "o_orderpriority",
        F.array(F.lit("a"), F.col("o_orderstatus")).alias("tags"),
        F.lit("").alias("blank"),
        F.when(priority == "1-URGENT", "")
        .when(priority == "2-HIGH", "None")
        .when(priority == "3-MEDIUM", "no date")
        .otherwise(day)
        .alias("created_text"),
        F.array("o_orderdate", F.lit(None).cast("timestamp_ntz")).alias("occurrences"),
        "o_orderdate",
        F.when(status != "F", F.col("o_orderdate") + F.expr("interval 10 days")).alias("expires"),
        F.when(status == "O", "true").when(status == "P", "maybe").otherwise("false").alias("open_text"),
        F.array(F.lit(""), F.lit("site"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")), key.cast("string")).alias("segments"),
    )


_ISO = "'%Y-%m-%dT%H:%M:%S+00:00'"
_EXTRACT_SQL = f"""SELECT CAST(o_orderkey AS VARCHAR) AS uid,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS portal_type,
  'a,' || o_orderstatus AS subject, o_orderpriority AS title,
  o_orderpriority || chr(10) || 'a' || chr(10) || o_orderstatus AS searchable,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '1900-01-01T00:00:00+00:00'
       WHEN o_orderpriority <> '3-MEDIUM' THEN strftime(date_trunc('day', o_orderdate), {_ISO}) END AS created,
  strftime(o_orderdate, {_ISO}) AS start,
  CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, {_ISO}) || '/' ||
       strftime(o_orderdate + INTERVAL 10 DAY, {_ISO}) END AS span,
  CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS is_open,
  '/site/c' || CAST(o_custkey AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) AS path,
  3 AS depth, CAST(o_custkey AS INTEGER) AS position FROM orders"""


@query(_EXTRACT_SQL)
def extract_all(spark, sf_dir):
    rows = derive_rows(_source(spark, sf_dir), EXTRACTED)
    span = F.concat_ws("/", V.iso_text(F.col("effectiveRange.since")), V.iso_text(F.col("effectiveRange.until")))
    return rows.select(
        "uid",
        "portal_type",
        F.array_join("Subject", ",").alias("subject"),
        F.col("Title").alias("title"),
        F.col("SearchableText").alias("searchable"),
        V.iso_text(F.col("created")).alias("created"),
        V.iso_text(F.col("start")).alias("start"),
        F.when(F.col("effectiveRange").isNotNull(), span).alias("span"),
        "is_open",
        "path.path",
        "path.depth",
        F.col("getObjPositionInParent").alias("position"),
    )


@query(f"SELECT uid, title, searchable, created FROM ({_EXTRACT_SQL})")
def extract_subset(spark, sf_dir):
    rows = derive_rows(_source(spark, sf_dir), EXTRACTED, ["Title", "SearchableText", "created"])
    return rows.select(
        "uid", F.col("Title").alias("title"), F.col("SearchableText").alias("searchable"), V.iso_text(F.col("created")).alias("created")
    )


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS uid, upper(o_orderpriority) AS "Description", o_orderstatus AS "Contact",
    CAST(NULL AS VARCHAR) AS "Unknown" FROM orders"""
)
def search_only_values(spark, sf_dir):
    """Search-only attributes: a named indexer, a plain content column, and neither."""
    source = C.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("uid"), "o_orderpriority", F.encode("o_orderstatus", "UTF-8").alias("Contact")
    )
    names = ["Description", "Contact", "Unknown"]
    return derive_rows(source, Registry([]), names, search_only=names, indexers={"Description": F.upper("o_orderpriority")})


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS uid, coalesce(CASE WHEN quality = 1 THEN 'good' END, '') AS grade,
    CASE WHEN quality = 1 THEN 'good' ELSE '' END AS tags, '/l/' || CAST(doc_id AS VARCHAR) AS path
    FROM documents LEFT JOIN labels USING (doc_id)"""
)
def extract_defaults(spark, sf_dir):
    """Stored values as read back: empty text, empty list, plain path."""
    registry = Registry(
        [
            IndexSpec("grade", "field", analyzed=False),
            IndexSpec("Subject", "keyword", many=True, sources=("grade",)),
            IndexSpec("path", "path", sources=("where",)),
        ]
    )
    docs = C.labelled(spark, sf_dir).select(
        "uid", F.when(F.col("quality") == 1, "good").alias("grade"), F.concat(F.lit("/l/"), "uid").alias("where")
    )
    rows = read_back(derive_rows(docs, registry), registry)
    return rows.select("uid", "grade", F.array_join("Subject", ",").alias("tags"), "path")


@query(
    f"""WITH {C.CONTENT_SQL} SELECT uid, upper(portal_type) AS portal_type, lang || ':' || upper(portal_type) AS label,
    n_chars > 1000 AS long FROM content"""
)
def provider_columns(spark, sf_dir):
    def louder(rows):
        return rows.withColumn("portal_type", F.upper("portal_type"))

    def label(rows):
        return rows.withColumn("label", F.concat_ws(":", "Language", "portal_type"))

    rows = derive_rows(
        C.content(spark, sf_dir),
        C.CONTENT,
        ["portal_type", "Language", "n_chars"],
        providers=[louder, label, lambda rows: rows.withColumn("long", F.col("n_chars") > 1000)],
    )
    return rows.select("uid", "portal_type", "label", "long")


@query("SELECT uid, extra, searchable FROM (SELECT CAST(p_partkey AS VARCHAR) AS uid, p_size AS extra, p_brand || chr(10) || p_name AS searchable FROM part) WHERE extra = 11")
def custom_schema(spark, sf_dir):
    """A registry with an overridden default and a field the catalog does not have."""
    registry = Registry().with_specs(
        IndexSpec("SearchableText", "text", sources=("p_brand", "p_name")),
        IndexSpec("extra", "field", sources=("p_size",), dtype=T.IntegerType()),
    )
    parts = C.table(spark, sf_dir, "part").withColumn("uid", F.col("p_partkey").cast("string"))
    rows = derive_rows(parts, registry, ["SearchableText", "extra"])
    found = SearchIndex(rows, registry).search({"extra": 11})
    return found.fields("extra", "SearchableText").select("uid", "extra", F.col("SearchableText").alias("searchable"))


@query(f"WITH {C.CONTENT_SQL} SELECT uid, portal_type FROM content WHERE lang = 'fr' AND n_chars >= 1000")
def custom_query(spark, sf_dir):
    """A caller's own query assembly: it adds a minimum length to every search."""

    def assemble(constraints, registry, schema, settings):
        plan = compile_query(constraints, registry, schema, settings)
        longer = F.col("n_chars") >= 1000
        return CompiledQuery(longer if plan.where is None else plan.where & longer, plan.clauses, plan.sort, plan.has_text)

    index = SearchIndex(C.content(spark, sf_dir), C.CONTENT, Settings(), assemble=assemble)
    return index.search({"Language": "fr"}).fields("portal_type").drop("score")


@query(f"WITH {C.CONTENT_SQL} SELECT uid, upper(lang) || '/' || portal_type AS label FROM content WHERE lang IN ('de', 'es')")
def row_factory(spark, sf_dir):
    def label(rows):
        return rows.select("uid", F.concat_ws("/", F.upper("Language"), "portal_type").alias("label"))

    return C.content_index(spark, sf_dir).search({"Language": ["de", "es"]}, row_factory=label).hits


# --- attachments: pages are files of the documents with their number ---


def _files(spark, sf_dir):
    pages = C.table(spark, sf_dir, "pages")
    name = F.concat(V.last_segment(F.regexp_extract("url", r"^([^?#]*)", 1)), F.lit(".html"))
    page = F.struct(name.alias("filename"), F.lit("text/html").alias("content_type"), F.encode("html", "UTF-8").alias("data"))
    note = F.struct(
        F.lit("note.txt").alias("filename"), F.lit("text/plain").alias("content_type"), F.encode("url", "UTF-8").alias("data")
    )
    image = F.struct(
        F.lit("x.png").alias("filename"), F.lit("image/png").alias("content_type"), F.encode("url", "UTF-8").alias("data")
    )
    none = F.struct(
        F.lit(None).cast("string").alias("filename"), F.lit("text/plain").alias("content_type"), F.lit(None).cast("binary").alias("data")
    )
    files = F.create_map(F.lit("file"), page, F.lit("file2"), note, F.lit("image"), image, F.lit("empty"), none)
    path = F.concat(F.lit("/site/docs/"), F.col("page_id").cast("string"))
    return pages.select(F.col("page_id").cast("string").alias("uid"), path.alias("path"), files.alias("files"))


_NAME_SQL = "regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '([^/]*)$', 1) || '.html'"
_FILES_SQL = f"""SELECT CAST(page_id AS VARCHAR) AS uid, 'file' AS fieldname, {_NAME_SQL} AS filename, {HTML_TEXT_SQL} AS content FROM pages
    UNION ALL SELECT CAST(page_id AS VARCHAR), 'file2', 'note.txt', trim(url) FROM pages"""


def _blobs(spark, sf_dir):
    rows = _files(spark, sf_dir)
    entries = rows.select("uid", F.explode("files").alias("fieldname", "file")).select("uid", "fieldname", "file.data")
    return blob_fields(rows, "/site").join(entries, ["uid", "fieldname"])


@query(f"SELECT uid, fieldname, 'docs/' || uid AS path, filename FROM ({_FILES_SQL})")
def blob_descriptors(spark, sf_dir):
    return blob_fields(_files(spark, sf_dir), "/site")


@query(
    """SELECT CAST(page_id AS VARCHAR) AS uid, 'file' AS fieldname, octet_length(encode(html)) AS bytes, md5(html) AS digest FROM pages"""
)
def blob_bytes(spark, sf_dir):
    """Pages and notes written as files; the bytes of the pages are read back, no note is opened."""
    base = full_uri(spark, fresh_path(spark, "blobs"))
    rows = _files(spark, sf_dir)
    entries = rows.select("uid", F.explode("files").alias("fieldname", "file")).select("uid", "fieldname", "file.data")
    fields = blob_fields(rows, "/site")
    write_blobs(fields.join(entries, ["uid", "fieldname"]), base).agg(F.sum("length")).collect()
    read = read_blobs(spark, base, fields.where("fieldname = 'file'"))
    return read.select("uid", "fieldname", F.octet_length("data").cast("long").alias("bytes"), F.md5("data").alias("digest"))


@query(f"SELECT uid, count(*) AS files, string_agg(fieldname || '=' || filename, ',' ORDER BY fieldname) AS names FROM ({_FILES_SQL}) GROUP BY uid")
def attachment_collect(spark, sf_dir):
    found = A.collect_attachments(A.extract_contents(_blobs(spark, sf_dir)))
    names = F.transform("attachments", lambda a: F.concat(a["fieldname"], F.lit("="), a["filename"]))
    return found.select("uid", F.size("attachments").cast("long").alias("files"), F.array_join(names, ",").alias("names"))


@query(
    f"""WITH files AS ({_FILES_SQL}), extra AS (SELECT uid, string_agg(content, '' ORDER BY fieldname) AS added FROM files GROUP BY uid)
    SELECT CAST(doc_id AS VARCHAR) AS uid, md5(text || coalesce(added, '')) AS digest, 0 AS bytes_left
    FROM documents LEFT JOIN extra ON uid = CAST(doc_id AS VARCHAR)"""
)
def attachment_append(spark, sf_dir):
    rows = C.content(spark, sf_dir).select("uid", "SearchableText")
    found = A.collect_attachments(A.extract_contents(_blobs(spark, sf_dir)))
    filled = A.append_contents(rows, found)
    left = F.size(F.filter(F.coalesce("attachments", F.array()), lambda a: a["data"].isNotNull()))
    return filled.select("uid", F.md5(F.encode("SearchableText", "UTF-8")).alias("digest"), left.alias("bytes_left"))


# --- value functions ---


@query(
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS uid, strftime(o_orderdate, {_ISO}) AS iso,
    strftime(date_trunc('day', o_orderdate), {_ISO}) AS midnight FROM orders"""
)
def iso_dates(spark, sf_dir):
    rows = C.table(spark, sf_dir, "orders")
    day = V.parse_instant(F.date_format("o_orderdate", "yyyy/MM/dd"))
    return rows.select(F.col("o_orderkey").cast("string").alias("uid"), V.iso_text(F.col("o_orderdate")).alias("iso"), V.iso_text(day).alias("midnight"))


@query(
    f"""WITH {C.TREE_SQL} SELECT path, CAST(depth AS INTEGER) AS depth, regexp_extract(path, '^(.*)/[^/]*$', 1) AS parent,
    regexp_extract(path, '([^/]*)$', 1) AS last,
    array_to_string(list_slice(string_split(path, '/'), 3, len(path)), '/') AS below,
    regexp_replace(path, '^/', '') AS joined FROM nodes"""
)
def path_functions(spark, sf_dir):
    path = F.col("path")
    return C.tree_paths(spark, sf_dir).select(
        path,
        V.path_depth(path).alias("depth"),
        V.parent_path(path).alias("parent"),
        V.last_segment(path).alias("last"),
        V.relative_path(path, "/AFRICA").alias("below"),
        V.join_segments(F.slice(V.path_segments(path), 2, F.size(V.path_segments(path)))).alias("joined"),
    )


@query(
    r"""SELECT CAST(o_orderkey AS VARCHAR) AS uid, regexp_replace('**' || o_orderpriority || '*', '^\*+|\*+$', '', 'g') AS trimmed,
    len(string_split(o_orderpriority || chr(10) || o_orderstatus, chr(10))) AS lines FROM orders"""
)
def text_functions(spark, sf_dir):
    starred = F.concat(F.lit("**"), "o_orderpriority", F.lit("*"))
    lines = V.line_list(F.concat_ws("\n", "o_orderpriority", "o_orderstatus"))
    return C.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("uid"), trim_stars(starred).alias("trimmed"), F.size(lines).cast("long").alias("lines")
    )
