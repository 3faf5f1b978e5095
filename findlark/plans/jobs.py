"""User-level jobs: convert, rebuild, synchronize, uncatalog, information."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.functions.values import size_mb
from findlark.operators import changes, reconcile
from findlark.plans.store import Commit, IndexStore, Version
from findlark.sources.content import Provider, derive_rows


def extract_rows(
    store: IndexStore,
    content: DataFrame,
    attributes: Iterable[str] | None = None,
    *,
    indexers: Mapping[str, Column] | None = None,
    providers: Sequence[Provider] = (),
) -> DataFrame:
    """Index rows of ``content`` under the store's registry and settings."""
    return derive_rows(
        content,
        store.registry,
        attributes,
        search_only=store.settings.search_only,
        indexers=indexers,
        providers=providers,
    )


def convert(store: IndexStore) -> Version:
    return store.convert()


def rebuild(store: IndexStore, content: DataFrame, **options) -> dict[str, float]:
    """Re-extract every attribute of every object into a new version; reports the time taken."""
    wall, cpu = time.time(), time.process_time()
    version = store.rebuild(extract_rows(store, content, **options))
    return {
        "version": version.number,
        "wall_seconds": time.time() - wall,
        "driver_cpu_seconds": time.process_time() - cpu,
    }


def synchronize(store: IndexStore, content: DataFrame, **options) -> dict[str, int]:
    """Index what the catalog has and the index lacks, delete what only the index has."""
    version = store.current()
    if version is not None and not version.parts and store.settings.enabled:
        # nothing is indexed: a base, not one overlay with everything
        store.rebuild(extract_rows(store, content, **options))
        return {"indexed": store.rows().count(), "deleted": 0}
    if version is None:
        return {"indexed": 0, "deleted": 0}
    catalog, rows = store.apart(content)
    missing = content.join(reconcile.not_indexed(catalog, rows), "uid", "left_semi")
    fresh = extract_rows(store, missing, **options)
    indexed = changes.full_indexes(fresh)
    removed = changes.deletes(reconcile.orphaned(catalog, rows), indexed.schema["payload"].dataType)
    done = store.commit(indexed.unionByName(removed))
    return {"indexed": done.indexed if done else 0, "deleted": done.deleted if done else 0}


def uncatalog(store: IndexStore, catalog: DataFrame, paths: DataFrame) -> Commit | None:
    """Delete the documents at the given catalog paths."""
    ids = reconcile.uncataloged_ids(catalog, paths)
    attributes = T.StructType([f for f in store.schema if f.name != "uid"])
    return store.commit(changes.deletes(ids, attributes))


def info(store: IndexStore, catalog: DataFrame) -> DataFrame:
    """Index name, document counts, deleted documents, size and query count in one row."""
    version = store.current()
    counts = reconcile.doc_counts(catalog, store.rows(version))
    return counts.select(
        F.lit(store.name).alias("index_name"),
        F.lit(version.number if version else None).cast("long").alias("version"),
        "catalog_docs",
        "index_docs",
        F.lit(version.deleted_total if version else 0).cast("long").alias("deleted_docs"),
        size_mb(F.lit(version.bytes if version else 0)).alias("size"),
        F.lit(version.queries_total if version else 0).cast("long").alias("query_count"),
    )
