"""A page corpus as content: title, body, links and the crawl frontier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlark.functions.text import fold_ascii
from findlark.functions.values import absolute_url

# Where an encyclopedia page keeps its heading and its body.
HEADING = r'(?is)<(\w+)[^>]*\bid="firstHeading"[^>]*>(.*?)</\1>'
BODY = r'(?is)(<(\w+)[^>]*\bid="bodyContent"[^>]*>.*</\2>)'


def page_documents(
    pages: DataFrame,
    *,
    title: tuple[str, int] = (HEADING, 2),
    body: tuple[str, int] = (BODY, 1),
    html: str = "html",
) -> DataFrame:
    """Pages with a plain ASCII-folded ``title`` and their ``body`` markup.

    ``title`` and ``body`` are a pattern and the group to take. Pages lacking either are
    skipped.
    """
    heading = F.regexp_replace(F.regexp_extract(html, *title), r"<[^>]*>", "")
    found = pages.withColumn("title", fold_ascii(heading)).withColumn(
        "body", F.regexp_extract(html, *body)
    )
    return found.where((F.col("title") != "") & (F.col("body") != ""))


def page_links(pages: DataFrame, base: Column | str, html: str = "html") -> DataFrame:
    """Every ``href`` of each page's anchors, site-relative ones made absolute."""
    pattern = r"""(?is)<a\s[^>]*?\bhref=["']([^"']*)["']"""
    found = pages.select("*", F.explode(F.regexp_extract_all(html, F.lit(pattern), F.lit(1))).alias("href"))
    return found.withColumn("target", absolute_url(F.col("href"), base))


def link_frontier(links: DataFrame, parsed: DataFrame, content_prefix: str) -> DataFrame:
    """Distinct link targets under the content prefix that are not parsed yet."""
    targets = links.where(F.col("target").startswith(content_prefix)).select(F.col("target").alias("url"))
    return targets.distinct().join(parsed.select("url"), "url", "left_anti")
