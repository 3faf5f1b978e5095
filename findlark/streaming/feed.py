"""A change feed applied to a stored index, one micro-batch per commit."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from findlark.config import Scratch
from findlark.operators import attachments as A
from findlark.operators import changes
from findlark.plans.store import Commit, IndexStore

Current = Callable[[], DataFrame]


def commit_batch(
    store: IndexStore,
    batch: DataFrame,
    batch_id: int | None = None,
    *,
    current: Current | None = None,
    partial: str = "merge",
) -> Commit | None:
    """Compact one batch and commit it. In deferred mode values are read now, by name."""
    if not store.active:
        return None
    pending = changes.compact(batch, store.attributes, partial)
    if not store.settings.deferred or current is None:
        return store.commit(pending, batch_id)
    with Scratch(store.spark) as scratch:
        named = scratch.write(pending, "named")
        return store.commit(changes.hydrate(named, current()), batch_id)


def with_retries(job: Callable[[], object], retries: int, seconds: float) -> object:
    """Run ``job``, again after a pause when it fails, at most ``retries`` more times."""
    for attempt in range(retries + 1):
        try:
            return job()
        except Exception:
            if attempt == retries:
                raise
            time.sleep(seconds)
    return None


def follow_feed(
    store: IndexStore,
    feed: DataFrame,
    checkpoint: str,
    *,
    current: Current | None = None,
    partial: str = "merge",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the stream that keeps ``store`` up to date.

    A batch that fails is retried and then stops the stream unpublished; on restart it is
    replayed under the same id, which the store applies once.
    """
    settings = store.settings

    def handle(batch: DataFrame, batch_id: int) -> None:
        with_retries(
            lambda: commit_batch(store, batch, batch_id, current=current, partial=partial),
            settings.retries,
            settings.retry_seconds,
        )

    writer = feed.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def attachment_updates(
    store: IndexStore, found: DataFrame
) -> DataFrame:
    """Pending updates that give documents their attachments and the text found in them.

    ``found`` has the collected attachments per uid. Those of documents the index does not
    hold, deleted ones included, are dropped.
    """
    rows = store.rows_of(found).select("uid", "SearchableText")
    filled = changes.full_indexes(A.append_contents(rows, found))
    return filled.withColumn("base", F.lit(None).cast("string"))


def commit_files(
    store: IndexStore,
    files: DataFrame,
    batch_id: int | None = None,
    *,
    extractor: A.Extractor = A.plain_extractor,
) -> Commit | None:
    """Extract one batch of files, once, and commit what it gives."""
    if not store.active:
        return None
    with Scratch(store.spark) as scratch:
        gathered = A.collect_attachments(A.extract_contents(files, extractor))
        found = scratch.write(gathered, "files")
        return store.commit(attachment_updates(store, found), batch_id, "attachments")


def follow_blobs(
    store: IndexStore,
    files: DataFrame,
    checkpoint: str,
    *,
    extractor: A.Extractor | None = A.plain_extractor,
    trigger: dict | None = None,
) -> StreamingQuery | None:
    """Start the second, lower-priority stream over file rows ``(uid, fieldname, filename, data)``.

    Start it after the change feed of the same documents. Without an extractor there is
    nothing to do. Its batches are counted apart from those of the change feed and are not
    retried.
    """
    if extractor is None:
        return None

    def handle(batch: DataFrame, batch_id: int) -> None:
        commit_files(store, batch, batch_id, extractor=extractor)

    writer = files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def drain(
    store: IndexStore,
    feed: DataFrame,
    files: DataFrame,
    checkpoint: str,
    *,
    extractor: A.Extractor | None = A.plain_extractor,
    **options,
) -> None:
    """Take in all that is waiting: changes first, then attachments."""
    follow_feed(store, feed, f"{checkpoint}/changes", **options).awaitTermination()
    blobs = follow_blobs(store, files, f"{checkpoint}/attachments", extractor=extractor)
    if blobs is not None:
        blobs.awaitTermination()
