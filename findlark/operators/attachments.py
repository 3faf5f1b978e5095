"""Attachments: gathering them per document and appending their text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlark.functions.text import bytes_to_text, html_text

Extractor = Callable[[Column, Column], Column]


def plain_extractor(filename: Column, data: Column) -> Column:
    """Text of plain, CSV and HTML files. Pass your own (a pandas UDF, say) for other formats."""
    text = bytes_to_text(data)
    name = F.lower(filename)
    return (
        F.when(name.rlike(r"\.x?html?$"), html_text(text))
        .when(name.rlike(r"\.(txt|text|csv|tsv|md)$"), F.trim(text))
        .otherwise(F.lit(None).cast("string"))
    )


def extract_contents(files: DataFrame, extractor: Extractor = plain_extractor) -> DataFrame:
    """File rows with their ``content``; one file is one row, so the work spreads by file.

    The bytes are dropped where text was found, empty text included.
    """
    rows = files.withColumn("content", extractor(F.col("filename"), F.col("data")))
    return rows.withColumn("data", F.when(F.col("content").isNull(), F.col("data")))


def collect_attachments(files: DataFrame) -> DataFrame:
    """One ``attachments`` array per document, in field name order.

    The array is part of the document's row, so its size is that of one document.
    """
    entry = F.struct("fieldname", "filename", "data", "content")
    gathered = files.groupBy("uid").agg(F.array_sort(F.collect_list(entry)).alias("attachments"))
    return gathered


def append_contents(
    rows: DataFrame, attachments: DataFrame, text: str = "SearchableText", separator: str = ""
) -> DataFrame:
    """Documents with their attachments; non-empty contents are appended to the text."""
    parts = F.filter(
        F.transform("_found", lambda a: a["content"]), lambda c: c.isNotNull() & (c != "")
    )
    extra = F.aggregate(
        parts, F.lit(""), lambda joined, content: F.concat(joined, F.lit(separator), content)
    )
    stored = F.transform(
        "_found",
        lambda a: F.struct(
            a["filename"].alias("filename"), a["fieldname"].alias("fieldname"), a["data"].alias("data")
        ),
    )
    joined = rows.join(attachments.withColumnRenamed("attachments", "_found"), "uid", "left")
    found = F.col("_found").isNotNull()
    base = F.coalesce(F.col(text), F.lit(""))
    kept = F.col("attachments") if "attachments" in rows.columns else F.lit(None)
    return (
        joined.withColumn(text, F.when(found, F.concat(base, extra)).otherwise(F.col(text)))
        .withColumn("attachments", F.when(found, stored).otherwise(kept))
        .drop("_found")
    )
