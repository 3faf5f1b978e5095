"""Hits joined back to the catalog, with the index record where the catalog has no row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_RID = -1


def join_catalog(hits: DataFrame, catalog: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Every hit with a ``row`` struct: the catalog's row, else the index record's with rid -1.

    ``hits`` has a ``uid`` and a ``path`` text column; ``catalog`` is unique on ``path`` and has
    a ``rid``. A hit carries its own index columns, so those are the record, and one join is
    enough; ``records``, unique on ``path``, takes their place where hits were reduced to
    paths. A hit without path has a null row.
    """
    columns = [name for name in catalog.columns if name not in ("path", "rid")]
    rid = F.lit(NO_RID).cast(catalog.schema["rid"].dataType).alias("rid")

    def record(source: DataFrame | None):
        have = source.columns if source is not None else ()
        values = [
            (F.col(c) if c in have else F.lit(None)).cast(catalog.schema[c].dataType).alias(c)
            for c in columns
        ]
        return F.struct(rid, *values)

    # hits without path get a key of their own, so they do not meet in one task
    key = F.coalesce(F.col("path"), F.concat(F.lit("\0"), F.col("uid")))
    joined = hits.withColumn("_record", record(hits if records is None else None))
    joined = joined.withColumn("_key", key)
    known = catalog.select(F.col("path").alias("_key"), F.struct("rid", *columns).alias("_catalog"))
    joined = joined.join(known, "_key", "left")
    row = F.coalesce(F.col("_catalog"), F.col("_record"))
    if records is not None:
        stored = records.select(F.col("path").alias("_key"), record(records).alias("_stored"))
        joined = joined.join(stored, "_key", "left")
        row = F.coalesce(F.col("_catalog"), F.col("_stored"), F.col("_record"))
    return joined.withColumn("row", F.when(F.col("path").isNotNull(), row)).drop(
        "_key", "_catalog", "_record", "_stored"
    )
