"""Documents to a training mix: five stages, each over all rows its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that :func:`run` writes as
Parquet in the shared folder and reads again as the next one's ``docs``. All but the last return
the columns of ``docs``. Nulls, repeated rows and empty tables are treated as the operators'
docstrings say. Columns other than those of ``documents`` may have any name: they travel in one
struct, so no operator meets them, and come back unchanged (the last stage replaces those that are
called like what it adds).
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from findlark.config import materialise
from findlark.llm import decontaminate, langid, lines, mixing, simhash
from findlark.llm.common import table

# A text of fewer characters is too short for its cosine to mean anything; only one without any
# letter is rejected then.
SURE_CHARS = 50
MIN_COSINE = 0.1


OWN = ("doc_id", "text", "lang", "source", "n_chars")


def columns(rows: DataFrame, like: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"`{name}`") for name in like.columns])


def apart(stage):
    """A stage that sees the columns of ``documents`` and one struct ``more`` with all others."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        more = [name for name in docs.columns if name not in OWN]
        own = [name for name in docs.columns if name in OWN]
        folded = docs.select(*own, F.struct(*[F.col(f"`{name}`") for name in more]).alias("more")) if more else docs
        rows = stage(spark, folded, sf_dir)
        added = [name for name in rows.columns if name not in folded.columns]
        kept = [name for name in docs.columns if name not in added]
        where = {name: F.col("more").getField(name) if name in more else F.col(name) for name in kept}
        return rows.select(*[column.alias(name) for name, column in where.items()], *added)

    return run_stage


@apart
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from them: those without a letter, and those of
    ``SURE_CHARS`` characters or more that resemble no language, are rejected."""
    rows = langid.identify(docs)
    sure = (F.length("text") < SURE_CHARS) | (F.col("score") >= MIN_COSINE)
    return columns(rows.where((F.col("lang_pred") != langid.UNKNOWN) & sure), docs)


@apart
def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated chunks of lines; one that loses all its words goes, and
    ``n_chars`` follows the text."""
    rows = lines.deduplicate(docs)
    emptied = (F.col("lines_removed") > 0) & ~F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]"))
    rows = rows.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        shorter = F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        rows = rows.withColumn("n_chars", shorter)
    return columns(rows, docs)


@apart
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.representatives(docs)


@apart
def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    held = found.select(F.col("doc_id").alias("_doc")).distinct()
    return docs.join(held, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_anti")


@apart
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes words from, with ``size, source_size, target, taken``."""
    new = ["size", "source_size", "target", "taken"]
    # rows repeated in full are numbered, so each meets its own share of the mix
    again = Window.partitionBy("doc_id", "_key").orderBy("_key")
    keyed = docs.drop(*new).withColumn("_key", F.xxhash64("text", "source"))
    amounts = mixing.mix(keyed, keys=["_key"])
    amounts = amounts.withColumn("_n", F.row_number().over(again)).select(
        F.col("doc_id").alias("_doc"), F.col("_key").alias("_same"), F.col("_n").alias("_m"), *new
    )
    numbered = keyed.withColumn("_n", F.row_number().over(again))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_same")) & (F.col("_n") == F.col("_m"))
    )
    rows = numbered.join(amounts.where("taken > 0"), same)
    return rows.select(*[F.col(f"`{name}`") for name in docs.columns if name not in new], *new)


STAGES = [
    ("language ID", language),
    ("line dedup", repeated_lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmarks),
    ("mixing sources to target weights", mixed),
]

# language ID is not expressible in SQL; tests compare each stage with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return docs
