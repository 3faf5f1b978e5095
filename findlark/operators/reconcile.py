"""Catalog and index side by side: differences, drift and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlark.functions.values import size_mb


def not_indexed(catalog: DataFrame, rows: DataFrame) -> DataFrame:
    """Ids the catalog has and the index lacks."""
    return catalog.select("uid").distinct().join(rows.select("uid"), "uid", "left_anti")


def orphaned(catalog: DataFrame, rows: DataFrame) -> DataFrame:
    """Ids the index has and the catalog lacks."""
    return rows.select("uid").join(catalog.select("uid"), "uid", "left_anti")


def digests(ids: DataFrame, bucket: Column) -> DataFrame:
    """``bucket, n, a, b`` per bucket of the ids at hand: two hashes of a set that do not depend on
    its order. Ids are not shuffled; each task sends one row per bucket."""
    seeds = (F.xxhash64("uid"), F.xxhash64("uid", F.lit(1)))
    return ids.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("n"), *[F.bit_xor(seed).alias(name) for name, seed in zip("ab", seeds)]
    )


def differing_buckets(catalog: DataFrame, rows: DataFrame, bucket: Column) -> DataFrame:
    """Buckets in which catalog and index do not hold the same ids, as far as digests tell.

    Equal digests of different sets would need two 64-bit hashes to agree; an id that one side holds
    twice makes its bucket differ.
    """
    left = digests(catalog, bucket).select("bucket", F.struct("n", "a", "b").alias("mine"))
    right = digests(rows, bucket).select("bucket", F.struct("n", "a", "b").alias("theirs"))
    return left.join(right, "bucket", "full").where(~F.col("mine").eqNullSafe(F.col("theirs"))).select("bucket")


def synchronized(catalog: DataFrame, rows: DataFrame, fresh: DataFrame) -> DataFrame:
    """Index rows after indexing what is missing (from ``fresh``) and dropping orphans."""
    kept = rows.join(catalog.select("uid"), "uid", "left_semi")
    missing = fresh.join(not_indexed(catalog, rows), "uid", "left_semi")
    return kept.unionByName(missing.select(*rows.columns))


def sync_totals(catalog: DataFrame, rows: DataFrame) -> DataFrame:
    """How many documents a synchronization indexes and deletes."""
    both = _presence(catalog, rows)
    return both.agg(
        F.count_if(F.col("in_catalog") & ~F.col("in_index")).alias("indexed"),
        F.count_if(~F.col("in_catalog") & F.col("in_index")).alias("deleted"),
    )


def _presence(catalog: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per id with where it is found, from a single grouping."""
    sides = catalog.select("uid", F.lit(True).alias("c")).unionByName(
        rows.select("uid", F.lit(False).alias("c"))
    )
    return sides.groupBy("uid").agg(
        F.bool_or("c").alias("in_catalog"), F.bool_or(~F.col("c")).alias("in_index")
    )


def doc_counts(catalog: DataFrame, rows: DataFrame) -> DataFrame:
    """Document counts of catalog and index in one row."""
    sides = catalog.select(F.lit(1).alias("c"), F.lit(0).alias("i")).unionByName(
        rows.select(F.lit(0).alias("c"), F.lit(1).alias("i"))
    )
    return sides.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("catalog_docs"),
        F.coalesce(F.sum("i"), F.lit(0)).alias("index_docs"),
    )


def drift_report(catalog: DataFrame, rows: DataFrame) -> DataFrame:
    """The two counts when they differ, no row when they agree."""
    return doc_counts(catalog, rows).where(F.col("catalog_docs") != F.col("index_docs"))


def index_info(catalog: DataFrame, rows: DataFrame, log: DataFrame) -> DataFrame:
    """Counts with the totals of the commit log: deleted documents, size, queries.

    ``log`` is ``(deleted, bytes, queries)``.
    """
    totals = log.agg(
        F.struct(
            F.coalesce(F.sum("deleted"), F.lit(0)).alias("deleted"),
            size_mb(F.coalesce(F.sum("bytes"), F.lit(0))).alias("size"),
            F.coalesce(F.sum("queries"), F.lit(0)).alias("queries"),
        ).alias("totals")
    ).scalar()
    counts = doc_counts(catalog, rows)
    return counts.select(
        "catalog_docs",
        "index_docs",
        totals["deleted"].alias("deleted_docs"),
        totals["size"].alias("size"),
        totals["queries"].alias("query_count"),
    )


def uncataloged_ids(catalog: DataFrame, paths: DataFrame) -> DataFrame:
    """Ids of the given paths; paths the catalog does not know are skipped."""
    return catalog.select("uid", "path").join(paths.select("path").distinct(), "path", "left_semi").select("uid")
