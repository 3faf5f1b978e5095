"""Page corpus: titles, links, frontier, placement in a hierarchy."""

from __future__ import annotations

from pyspark.sql import functions as F

from findlark.plans.search import SearchIndex
from findlark.functions.values import path_struct
from findlark.sources import hierarchy as H
from findlark.sources.pages import link_frontier, page_documents, page_links
from findlark.workload import common as C

QUERIES = C.Catalogue()
query = QUERIES.add

TITLE = (r"(?is)<h1[^>]*>(.*?)</h1>", 1)
BODY = (r"(?is)<article[^>]*>.*</article>", 0)
SITE = r"^(https?://[^/]*)"


@query(
    r"""SELECT page_id, strip_accents(replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g'), 'ß', 'ss')) AS title,
    md5(regexp_extract(html, '(?is)<article[^>]*>.*</article>')) AS body
    FROM pages WHERE regexp_matches(html, '(?is)<h1[^>]*>.+?</h1>') AND regexp_matches(html, '(?is)<article[^>]*>.*</article>')"""
)
def page_title_body(spark, sf_dir):
    docs = page_documents(C.table(spark, sf_dir, "pages"), title=TITLE, body=BODY)
    return docs.select("page_id", "title", F.md5(F.encode("body", "UTF-8")).alias("body"))


_LINKS = r"""links AS (
  SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?\bhref=["'']([^"'']*)["'']', 1)) AS href,
         regexp_extract(url, '^(https?://[^/]*)', 1) AS base FROM pages),
targets AS (SELECT page_id, href, CASE WHEN href LIKE '/%' THEN base || href ELSE href END AS target FROM links)"""


def _links(spark, sf_dir):
    pages = C.table(spark, sf_dir, "pages")
    return page_links(pages, F.regexp_extract("url", SITE, 1))


@query(f"WITH {_LINKS} SELECT page_id, href, target FROM targets")
def page_link_targets(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", "href", "target")


@query(
    f"""WITH {_LINKS} SELECT DISTINCT target AS url FROM targets
    WHERE starts_with(target, 'https://') AND target NOT IN (SELECT url FROM pages)"""
)
def frontier(spark, sf_dir):
    return link_frontier(_links(spark, sf_dir), C.table(spark, sf_dir, "pages"), "https://")


@query(
    f"""WITH {_LINKS}, parsed AS (SELECT url FROM pages UNION SELECT min(target) FROM targets GROUP BY page_id)
    SELECT DISTINCT target AS url FROM targets WHERE starts_with(target, 'http') AND target NOT IN (SELECT url FROM parsed)"""
)
def frontier_next_round(spark, sf_dir):
    """A second round: one link of every page has been parsed in the meantime."""
    links = _links(spark, sf_dir)
    pages = C.table(spark, sf_dir, "pages").select("url")
    done = links.groupBy("page_id").agg(F.min("target").alias("url")).select("url")
    return link_frontier(links, pages.unionByName(done), "http")


def _placement_sql(number: str, source: str) -> str:
    total, sizes = H.folder_count(), [1 + H.folder_count(H.MAX_DEPTH - level - 1) for level in range(H.MAX_DEPTH)]
    steps = [f"p0 AS (SELECT {number} AS slot, ({number} // {H.PAGES_PER_FOLDER}) AS folder FROM {source})"]
    steps.append(f"p1 AS (SELECT slot, folder, folder % {total} AS rest, '/site' || (folder // {total}) || '' AS path, false AS done FROM p0)")
    for level, size in enumerate(sizes):
        steps.append(
            f"""p{level + 2} AS (SELECT slot, folder, rest % {size} - 1 AS rest,
    CASE WHEN done THEN path ELSE path || '/folder' || (rest // {size}) END AS path,
    done OR rest % {size} = 0 AS done FROM p{level + 1})"""
        )
    types = ", ".join(f"'{name}'" for name in H.PAGE_TYPES)
    return f"""WITH {", ".join(steps)}
    SELECT slot, path || '/page' || (slot % {H.PAGES_PER_FOLDER}) AS path,
    [{types}][CAST(('0x' || substr(md5(CAST(slot AS VARCHAR)), 1, 8)) AS BIGINT) % 3 + 1] AS page_type FROM p{len(sizes) + 1}"""


@query(_placement_sql("o_orderkey", "orders"))
def tree_generator(spark, sf_dir):
    """Orders stand in for pages: each takes the next page slot, depth first."""
    rows = C.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("slot"))
    return H.place(rows, "slot")


@query(f"SELECT slot, path FROM ({_placement_sql('doc_id', 'documents')}) WHERE starts_with(path, '/site0/folder0/folder0') AND page_type = 'Event'")
def tree_search(spark, sf_dir):
    """Documents placed in the hierarchy, then searched by folder and type."""
    rows = C.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("slot"))
    placed = H.place(rows, "slot").select(
        F.col("slot").cast("string").alias("uid"), "slot", path_struct(F.col("path")).alias("path"), F.col("page_type").alias("portal_type")
    )
    found = SearchIndex(placed, C.CONTENT).search({"path": "/site0/folder0/folder0", "portal_type": "Event"})
    return found.hits.select("slot", "path.path")
