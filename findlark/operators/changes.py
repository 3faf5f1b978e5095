"""Change feeds: compaction to pending actions and their application to index rows.

A feed row is ``(uid, seq, op, attributes, payload)``: ``op`` is ``index``, ``reindex`` or
``unindex``, ``attributes`` names what ``payload`` (a struct of index attributes) sets. An
empty list, or one naming every attribute, is a full index. ``seq`` is unique per uid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPS = ("index", "update", "delete")


def payload_names(feed: DataFrame) -> list[str]:
    payload = feed.schema["payload"].dataType
    assert isinstance(payload, T.StructType)
    return payload.names


def compact(feed: DataFrame, every: Sequence[str], partial: str = "merge") -> DataFrame:
    """One row per uid: ``(uid, base, attributes, payload)``.

    ``every`` names the attributes of the index: a change that names all of them is a full
    index, however narrow or wide its payload is. ``base`` is ``index``, ``delete`` or null; ``attributes`` lists what a partial update
    sets (all of them for an index). Only the last full index or delete and the last value
    of each attribute matter. Which these are is one aggregation over sequence numbers alone,
    whose per-map partial results are one row per uid, however many changes a single uid has; the
    payloads of the changes that won, at most one for each attribute, are fetched after it by uid
    and number. Payloads that lost are never sorted, aggregated or kept.

    A later partial adds to an earlier one, or replaces it with ``partial="replace"``. A
    partial after a delete stays pending next to it; a full index after a delete wins.
    """
    names = payload_names(feed)
    named = F.coalesce(F.col("attributes"), F.array().cast("array<string>"))
    everything = F.array(*[F.lit(name) for name in every]).cast("array<string>")
    covers = (F.size(named) == 0) | (F.size(F.array_except(everything, named)) == 0)
    removal = F.col("op") == "unindex"
    full = ~removal & covers
    part = ~removal & ~covers
    seq = F.col("seq")

    marked = feed.where(F.col("uid").isNotNull()).select(
        "uid",
        F.when(removal | full, seq).alias("_base_seq"),
        full.alias("_full"),
        F.when(part, seq).alias("_part_seq"),
        *[
            F.when(full | (part & F.array_contains(named, name)), seq).alias(f"q_{i}")
            for i, name in enumerate(names)
        ],
    )
    last = marked.groupBy("uid").agg(
        F.max("_base_seq").alias("_base_seq"),
        F.max_by("_full", "_base_seq").alias("_full"),
        F.max("_part_seq").alias("_part_seq"),
        *[F.max(f"q_{i}").alias(f"q_{i}") for i in range(len(names))],
    )
    live = []
    for i in range(len(names)):
        current = F.col(f"q_{i}")
        alive = current.isNotNull() & (
            F.col("_base_seq").isNull() | (current >= F.col("_base_seq"))
        )
        if partial == "replace":
            alive &= F.coalesce(F.col("_full"), F.lit(False)) | (current == F.col("_part_seq"))
        live.append(F.when(F.coalesce(alive, F.lit(False)), current).alias(f"q_{i}"))
    base = F.when(F.col("_full"), "index").when(~F.col("_full"), "delete")
    pending = last.select("uid", base.alias("base"), *live)

    numbers = F.array_distinct(F.array_compact(F.array(*[F.col(f"q_{i}") for i in range(len(names))])))
    won = pending.select("uid", F.explode(numbers).alias("seq"))
    fetched = feed.select("uid", "seq", "payload").join(won, ["uid", "seq"])
    # at most as many as there are attributes
    fetched = fetched.groupBy("uid").agg(F.collect_list(F.struct("seq", "payload")).alias("_won"))
    joined = pending.join(fetched, "uid", "left")

    def value(i: int, name: str) -> Column:
        mine = F.filter("_won", lambda w: w["seq"] == F.col(f"q_{i}"))
        return F.get(mine, F.lit(0))["payload"][name]

    sets = [F.when(F.col(f"q_{i}").isNotNull(), F.lit(n)) for i, n in enumerate(names)]
    return joined.select(
        "uid",
        "base",
        F.array_compact(F.array(*sets)).alias("attributes"),
        F.struct(*[value(i, n).alias(n) for i, n in enumerate(names)]).alias("payload"),
    )


def actions(compacted: DataFrame) -> DataFrame:
    """Pending actions ``(stage, op, uid, attributes, payload)``; stages apply in order 0, 1, 2."""
    has_update = (F.size("attributes") > 0) & (F.coalesce(F.col("base"), F.lit("")) != "index")
    ops = F.array_compact(
        F.array(
            F.when(F.col("base") == "index", F.lit(0)),
            F.when(has_update, F.lit(1)),
            F.when(F.col("base") == "delete", F.lit(2)),
        )
    )
    rows = compacted.select("uid", "attributes", "payload", F.explode(ops).alias("stage"))
    names = F.array(*[F.lit(op) for op in OPS])
    no_payload = F.col("stage") == 2
    return rows.select(
        "stage",
        F.element_at(names, F.col("stage") + 1).alias("op"),
        "uid",
        F.when(no_payload, F.array().cast("array<string>")).otherwise(F.col("attributes")).alias("attributes"),
        F.when(~no_payload, F.col("payload")).alias("payload"),
    )


def pending_counts(compacted: DataFrame) -> DataFrame:
    """Pending actions per kind and in total."""
    op = actions(compacted.select("uid", "base", "attributes", F.lit(None).cast("string").alias("payload")))
    return op.agg(
        F.count_if(F.col("op") == "index").alias("n_index"),
        F.count_if(F.col("op") == "update").alias("n_update"),
        F.count_if(F.col("op") == "delete").alias("n_delete"),
        F.count("*").alias("n_pending"),
    )


def apply_changes(rows: DataFrame, compacted: DataFrame) -> DataFrame:
    """Index rows after all pending actions: full index, then partial update, then delete.

    ``rows`` is joined once and keeps its place when the changes are small enough for Spark
    to broadcast; indexed rows are appended rather than joined, so only partial updates take their
    payload into the join.
    """
    names = [name for name in rows.columns if name != "uid"]
    available = compacted.schema["payload"].dataType.names
    partial = F.col("base").isNull()
    joined = rows.join(
        compacted.select(
            "uid",
            F.col("base").alias("_base"),
            F.when(partial, F.col("attributes")).alias("_set"),
            F.when(partial, F.col("payload")).alias("_new"),
        ),
        "uid",
        "left",
    )
    kept = joined.where(F.col("_base").isNull())
    merged = kept.select(
        "uid",
        *[
            (
                F.when(F.array_contains("_set", n), F.col(f"_new.{n}")).otherwise(F.col(n))
                if n in available
                else F.col(n)
            ).alias(n)
            for n in names
        ],
    )
    added = compacted.where(F.col("base") == "index").select(
        "uid",
        *[
            (F.col(f"payload.{n}") if n in available else F.lit(None).cast(rows.schema[n].dataType)).alias(n)
            for n in names
        ],
    )
    return merged.unionByName(added)


def rejected(rows: DataFrame, compacted: DataFrame) -> DataFrame:
    """Partial updates whose document is not in the index: reported, not inserted."""
    updates = actions(compacted).where(F.col("op") == "update")
    return updates.join(rows.select("uid"), "uid", "left_anti")


def hydrate(compacted: DataFrame, current: DataFrame) -> DataFrame:
    """Deferred mode: take the values of the named attributes from the current index rows.

    An object that is gone by now has nothing to index; its deletes still pass.
    """
    names = compacted.schema["payload"].dataType.names
    # the pending ids are few next to the content: it is reduced to them before it is joined
    wanted = current.join(compacted.select("uid"), "uid", "left_semi")
    values = wanted.select("uid", F.struct(*names).alias("_current"))
    joined = compacted.join(values, "uid", "left")
    removed = F.col("base") == "delete"
    fetched = F.struct(
        *[
            F.when(F.array_contains("attributes", n), F.col(f"_current.{n}")).alias(n)
            for n in names
        ]
    )
    return joined.where(F.col("_current").isNotNull() | F.coalesce(removed, F.lit(False))).select(
        "uid", "base", "attributes", fetched.alias("payload")
    )


def feed_rows(
    rows: DataFrame, op: str | Column, seq: Column, attributes: Sequence[str] = ()
) -> DataFrame:
    """Feed rows that index or reindex the given index rows."""
    names = [name for name in rows.columns if name != "uid"]
    return rows.select(
        "uid",
        seq.alias("seq"),
        (F.lit(op) if isinstance(op, str) else op).alias("op"),
        F.array(*[F.lit(a) for a in attributes]).cast("array<string>").alias("attributes"),
        F.struct(*names).alias("payload"),
    )


def full_indexes(rows: DataFrame) -> DataFrame:
    """Pending actions that index the given rows, each uid being there once."""
    names = [name for name in rows.columns if name != "uid"]
    return rows.select(
        "uid",
        F.lit("index").alias("base"),
        F.array(*[F.lit(n) for n in names]).alias("attributes"),
        F.struct(*names).alias("payload"),
    )


def deletes(ids: DataFrame, payload: T.DataType) -> DataFrame:
    """Pending actions that delete the given uids; ``payload`` is the type to be unioned with."""
    return ids.select(
        "uid",
        F.lit("delete").alias("base"),
        F.array().cast("array<string>").alias("attributes"),
        F.lit(None).cast(payload).alias("payload"),
    )


def differing_rows(left: DataFrame, right: DataFrame, key: str = "uid") -> DataFrame:
    """Keys whose rows differ between two tables of the same columns."""
    names = [name for name in left.columns if name != key]
    joined = left.select(key, F.struct(*names).alias("_left")).join(
        right.select(key, F.struct(*names).alias("_right")), key, "full"
    )
    return joined.where(~F.col("_left").eqNullSafe(F.col("_right"))).select(key)

