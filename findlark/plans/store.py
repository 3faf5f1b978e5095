"""Versioned index tables in a shared folder.

A version is a *base*, written by a rebuild, and a few *overlays*, one per commit. An overlay
holds the new rows of the documents a commit touched, their postings, the change of the word
counts, and the touched ids. Readers take the newest row of every id, so a commit costs
what its batch costs. After some commits the overlays are folded into one, and into a new
base when they have grown to a share of it.

A version becomes visible by one small file named after its number, created only if there is
none: of two writers from the same head one is first, and the other starts again from the new
head. Parts have numbers of their own, drawn for each attempt, so attempts never share a folder,
and one that fails leaves only files nobody reads. The file of a version holds all that is
needed of the log: totals, sizes of parts, and the last batch of every stream of batches.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field, fields, replace
from functools import cached_property, reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.config import (
    Scratch,
    Settings,
    create_exclusive,
    file_names,
    file_text,
    folder_bytes,
    remove,
)
from findlark.functions.values import index_name
from findlark.operators import postings as P
from findlark.operators import reconcile
from findlark.operators.changes import apply_changes, rejected
from findlark.operators.textmatch import LAYOUT_COLUMNS, StoredText
from findlark.plans.search import SearchIndex
from findlark.registry import Registry

_VERSIONS = (
    "version long, base long, overlays array<long>, buckets int, indexed long, updated long, "
    "deleted long, rejected long, bytes long, deleted_total long, queries_total long"
)
# files of versions that are kept for readers of the log; older ones are removed
KEPT_VERSIONS = 100
# bits of a part's number that tell attempts at the same version apart
ATTEMPT_BITS = 24
# the bucket folder of all rows of an overlay
OVERLAY = -1
_POSTINGS = "uid string, field string, term string, run int, tf int, len int, positions array<int>"
# a word may have several rows: by bucket, run and frequency, and signed ones of overlays
_TERMS = "field string, term string, run int, df long, tf int, len int"
# rows in a page of a file of documents or postings, the least that a scan of a subtree or of some
# words' first runs reads
PAGE_ROWS = 1000
_FIELDS = "field string, n long, words long"
# postings, in bytes of their files, whose word counts one task sorts and writes
COUNT_BYTES = 1 << 27


@dataclass(frozen=True)
class Version:
    """A published version; ``base`` is unset until a rebuild, ``buckets`` is what it was split into.

    ``base`` and ``overlays`` are numbers of parts, ``sizes`` their bytes, ``applied`` the last
    batch of each stream.
    """

    number: int
    base: int | None = None
    overlays: tuple[int, ...] = ()
    buckets: int = 1
    sizes: Mapping[str, int] = field(default_factory=dict)
    applied: Mapping[str, int] = field(default_factory=dict)
    deleted_total: int = 0
    queries_total: int = 0

    @property
    def parts(self) -> tuple[int, ...]:
        return self.overlays if self.base is None else (self.base, *self.overlays)

    @property
    def bytes(self) -> int:
        return sum(self.sizes.get(str(part), 0) for part in self.parts)


class HeadMoved(Exception):
    """Another writer published first."""


@dataclass(frozen=True)
class Commit:
    """What a commit did; ``refused`` holds the partial updates that found no document."""

    version: Version
    indexed: int
    updated: int
    deleted: int
    refused: DataFrame


class IndexStore:
    """An index under ``root``, named after its site path."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        registry: Registry,
        settings: Settings | None = None,
        *,
        site: str = "/site",
        name: str | None = None,
    ):
        if clash := {*LAYOUT_COLUMNS, "_shard"} & set(registry):
            raise ValueError(f"these names are taken by the stored tables: {sorted(clash)}")
        self.spark, self.registry = spark, registry
        self.settings = settings or Settings()
        self.name = index_name(site, name)
        self.path = f"{root.rstrip('/')}/{self.name}"

    # --- layout ---

    @cached_property
    def schema(self) -> T.StructType:
        return self.registry.struct_type(self.settings.search_only)

    @cached_property
    def attributes(self) -> list[str]:
        """Attributes a full index names: all but the key and the attachments."""
        return [f.name for f in self.registry.struct_type(self.settings.search_only, attachments=False) if f.name != "uid"]

    @cached_property
    def text_fields(self) -> list[str]:
        return self.registry.text_fields(self.settings.search_only)

    @cached_property
    def _by_path(self) -> list[str]:
        """What documents are sorted by inside a file: a subtree is then one range of rows, which
        the statistics of its row groups and pages tell from the rest."""
        return [f"{spec.name}.path" for spec in self.registry.values() if spec.kind == "path"][:1]

    @cached_property
    def _doc_schema(self) -> T.StructType:
        words = T.StructType([T.StructField(f, T.IntegerType()) for f in self.text_fields])
        terms = T.StructType([T.StructField(f, T.ArrayType(T.StringType())) for f in self.text_fields])
        counted = [T.StructField("words", words), T.StructField("terms", terms)] if self.text_fields else []
        return T.StructType([*self.schema.fields, *counted])

    # --- versions ---

    def _numbers(self) -> list[int]:
        names = file_names(self.spark, f"{self.path}/versions")
        return sorted(int(name.removesuffix(".json")) for name in names if name[0].isdigit())

    def _record(self, number: int) -> dict | None:
        """What the file of a version holds; ``None`` if its writer stopped before it was complete."""
        try:
            return json.loads(file_text(self.spark, f"{self.path}/versions/{number}.json"))
        except json.JSONDecodeError:
            return None

    def versions(self) -> DataFrame:
        """The commit log: one row for each of the latest versions."""
        records = [r for r in map(self._record, self._numbers()) if r]
        names = T.StructType.fromDDL(_VERSIONS).names
        return self.spark.createDataFrame([tuple(r[n] for n in names) for r in records], _VERSIONS)

    def _head(self) -> tuple[Version | None, int]:
        """The newest version, and the number of the next one."""
        numbers = self._numbers()
        for number in reversed(numbers):
            record = self._record(number)
            if record:
                names = {f.name for f in fields(Version)} - {"number", "overlays"}
                kept = {name: record[name] for name in names}
                return Version(number, overlays=tuple(record["overlays"]), **kept), numbers[-1] + 1
        return None, numbers[-1] + 1 if numbers else 1

    def current(self) -> Version | None:
        return self._head()[0]

    @property
    def converted(self) -> bool:
        return self.current() is not None

    @property
    def active(self) -> bool:
        """Changes are taken only when the index is enabled and has a version."""
        return self.settings.enabled and self.converted

    def _publish(self, version: Version, **counts: int) -> Version:
        """Make a version visible; :class:`HeadMoved` if its number is taken by now."""
        written = {str(p): version.sizes.get(str(p)) or self._part_bytes(p) for p in version.parts}
        totals = version.deleted_total + counts.get("deleted", 0), version.queries_total + counts.get("queries", 0)
        version = replace(version, sizes=written, deleted_total=totals[0], queries_total=totals[1])
        names = ("indexed", "updated", "deleted", "rejected")
        record = asdict(version) | {name: counts.get(name, 0) for name in names}
        record |= {"version": record.pop("number"), "bytes": version.bytes}
        file = f"{self.path}/versions/{version.number}.json"
        if not create_exclusive(self.spark, file, json.dumps(record).encode()):
            raise HeadMoved(version.number)
        for number in self._numbers()[:-KEPT_VERSIONS]:
            remove(self.spark, f"{self.path}/versions/{number}.json")
        return version

    def _publishing(self, attempt: Callable[[Version | None, int], Version | Commit | None]):
        """Run an attempt on the head, again on the new one as often as another writer was first."""
        while True:
            try:
                return attempt(*self._head())
            except HeadMoved:
                continue

    def _part(self, number: int) -> int:
        """Number of a new part: later versions have larger ones, attempts different ones."""
        return (number << ATTEMPT_BITS) | random.getrandbits(ATTEMPT_BITS)

    def _part_bytes(self, part: int) -> int:
        tables = ("docs", "postings") if self.text_fields else ("docs",)
        return sum(folder_bytes(self.spark, self._folder(table, part)) for table in tables)

    def count_queries(self, queries: int) -> Version | None:
        """Add to the number of searches the log tells of."""

        def attempt(head, number):
            return head and self._publish(replace(head, number=number), queries=queries)

        return self._publishing(attempt)

    # --- reading ---

    def _read(self, table: str, schema: T.StructType | str, version: Version | None) -> DataFrame:
        """All parts of a table, with the part in ``v`` and the hash bucket in ``bucket``."""
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        schema = T.StructType(
            [*schema.fields, T.StructField("v", T.LongType()), T.StructField("bucket", T.IntegerType())]
        )
        if version is None or not version.parts:
            return self.spark.createDataFrame([], schema)
        folder = f"{self.path}/{table}"
        paths = [f"{folder}/v={v}" for v in version.parts]
        return self.spark.read.schema(schema).option("basePath", folder).parquet(*paths)

    def _live(self, rows: DataFrame, version: Version | None) -> DataFrame:
        """Rows that no later part replaces.

        The touched ids are as many as the overlays changed; Spark broadcasts them while
        they are small and shuffles both sides when they are not.
        """
        if version is None or not version.overlays:
            return rows
        last = self._touched(version).groupBy("uid").agg(F.max("v").alias("_last"))
        joined = rows.join(last, "uid", "left")
        return joined.where(F.col("_last").isNull() | (F.col("v") >= F.col("_last"))).drop("_last")

    def _touched(self, version: Version) -> DataFrame:
        folder = f"{self.path}/touched"
        paths = [f"{folder}/v={v}" for v in version.overlays]
        return self.spark.read.schema("uid string, v long").option("basePath", folder).parquet(*paths)

    def rows(self, version: Version | None = None) -> DataFrame:
        """Index rows of a version, the newest by default."""
        version = version or self.current()
        return self._live(self._read("docs", self.schema, version), version).select(*self.schema.names)

    def ids(self, version: Version | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Uids of a version; only the files of the given buckets are read."""
        version = version or self.current()
        docs = self._read("docs", "uid string", version)
        if buckets is not None:
            docs = docs.where(F.col("bucket").isin(OVERLAY, *buckets))
        rows = self._live(docs, version).select("uid")
        return rows if buckets is None else rows.where(_bucket(version.buckets).isin(*buckets))

    def apart(self, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Ids of catalog and index in the buckets where they are not the same.

        Both sides are read once for the digests of their ids; the ids themselves, and the joins
        on them, are those of the differing buckets.
        """
        version = self.current()
        bucket = _bucket(version.buckets)
        ids = catalog.select("uid").where("uid is not null")
        found = reconcile.differing_buckets(ids, self.ids(version), bucket)
        # at most as many numbers as the version has buckets
        numbers = [row["bucket"] for row in found.collect()]
        if len(numbers) == version.buckets:
            return ids, self.ids(version)
        if not numbers:
            return ids.limit(0), self.ids(version).limit(0)
        return ids.where(bucket.isin(*numbers)), self.ids(version, numbers)

    def rows_of(
        self, ids: DataFrame, buckets: list[int] | None = None, version: Version | None = None
    ) -> DataFrame:
        """Index rows of the given uids; only the files of their buckets are read."""
        version = version or self.current()
        if buckets is None:
            buckets = ids.select(_buckets(version)).first()[0]
        here = F.col("bucket").isin(OVERLAY, *buckets)
        docs = self._read("docs", self.schema, version).where(here)
        rows = self._live(docs, version).join(ids.select("uid"), "uid", "left_semi")
        return rows.select(*self.schema.names)

    def _replaced(self, ids: DataFrame, buckets: list[int], version: Version) -> DataFrame:
        """What the documents of the given uids count for: words per field, and which.

        That is all a commit needs of a document it replaces or deletes; no attribute is read.
        """
        here = F.col("bucket").isin(OVERLAY, *buckets)
        docs = self._live(self._read("docs", self._doc_schema, version).where(here), version)
        counted = ("words", "terms") if self.text_fields else ()
        return docs.select("uid", *counted).join(ids.select("uid"), "uid", "left_semi")

    def index(self, settings: Settings | None = None) -> SearchIndex:
        """The newest version, searchable through its postings."""
        version = self.current()
        docs = self._live(self._read("docs", self._doc_schema, version), version)
        text = None
        if self.text_fields:
            text = StoredText(
                docs,
                self._read("postings", _POSTINGS, version),
                self._read("terms", _TERMS, version),
                self._read("fields", _FIELDS, version),
                live=lambda rows: self._live(rows, version),
            )
        return SearchIndex(
            docs.select(*self.schema.names), self.registry, settings or self.settings, text
        )

    # --- writing ---

    def _folder(self, table: str, number: int) -> str:
        return f"{self.path}/{table}/v={number}"

    def _bucket_count(self, rows: DataFrame) -> int:
        """Buckets of a new base: as set, or one for every ``bucket_bytes`` of text."""
        if self.settings.buckets:
            return self.settings.buckets
        named = [f for f in self.text_fields if f in rows.columns]
        sizes = [F.coalesce(F.octet_length(f), F.lit(0)) for f in named]
        total = rows.agg(F.sum(reduce(add, sizes)).alias("n")).first()["n"] if sizes else 0
        return 1 + (total or 0) // self.settings.bucket_bytes

    def _write_docs(self, rows: DataFrame, part: int, buckets: int | None) -> None:
        """Write the documents of a part, then their postings from the files written.

        A base (``buckets`` given) is shuffled by bucket and a shard of it, one task each, with
        more shards than ``files_per_bucket`` where a task would have too much text; an
        overlay by uid, into one folder. Words are grouped where their document lies. Nothing
        is cached: the second step reads the text columns of the files. The runs of a base leave
        its postings in the order of the files.
        """
        rows, named = self._shape(rows), self.text_fields
        shards = self.settings.files_per_bucket
        if buckets is None:
            keys, bucket = ("uid",), F.lit(OVERLAY)
        else:
            keys, bucket = ("bucket", "_shard"), _bucket(buckets)
            if named:
                shards = max(shards, -(-P.tasks(rows, named) // buckets))

        def placed(docs: DataFrame, *number: int) -> DataFrame:
            docs = docs.withColumn("bucket", bucket)
            return docs.repartition(*number, *keys) if buckets is None else _dealt(docs, buckets, "uid", shards)

        docs = placed(rows).drop("_shard")
        if named:
            docs = P.with_words(docs, named)
        docs = docs.sortWithinPartitions("bucket", *self._by_path, "uid")
        _by_bucket(docs, self._folder("docs", part), PAGE_ROWS, named="uid")
        if named:
            texts = self._read("docs", self.schema, Version(0, part)).select("uid", *named)
            texts = placed(texts, P.tasks(texts, named)) if buckets is None else placed(texts)
            # overlays are small: one run, which every search reads
            means = None if buckets is None else self._means(part)
            inverted = P.inverted(texts, named, tuple(dict.fromkeys(("bucket", *keys, "uid"))), means).drop("_shard")
            order = ("uid",) if buckets is None else ()
            inverted = inverted.sortWithinPartitions("bucket", "field", "term", "run", *order)
            _by_bucket(inverted, self._folder("postings", part), PAGE_ROWS)

    def _means(self, part: int) -> dict[str, float | None]:
        """Mean words of each text field over the documents of a part."""
        docs = self._read("docs", self._doc_schema, Version(0, part))
        return docs.agg(*[F.avg(F.nullif(f"words.{f}", F.lit(0))).alias(f) for f in self.text_fields]).first().asDict()

    def _write_counts(self, terms: DataFrame, totals: DataFrame, number: int, buckets: int | None) -> None:
        """Write document counts per word and word totals per field, signed in an overlay.

        Those of a base (``buckets`` given) are dealt by bucket and a shard of its words, one task each
        and more of them the more postings there are.
        """
        if buckets is None:
            terms = terms.repartition("bucket", "term")
        else:
            size = folder_bytes(self.spark, self._folder("postings", number))
            shards = max(self.settings.files_per_bucket, -(-size // (buckets * COUNT_BYTES)))
            terms = _dealt(terms, buckets, "term", shards).drop("_shard")
        _by_bucket(terms.sortWithinPartitions("bucket", "field", "term"), self._folder("terms", number))
        _by_bucket(totals.repartition("bucket"), self._folder("fields", number))

    def _counts(self, version: Version) -> tuple[DataFrame, DataFrame]:
        """Word and field counts of a part, from its documents and postings."""
        terms = P.run_statistics(self._read("postings", _POSTINGS, version), ("bucket",))
        docs = self._read("docs", self._doc_schema, version)
        return terms, P.field_statistics(docs, self.text_fields, ("bucket",))

    def _write_base(self, rows: DataFrame, number: int) -> Version:
        """Write a base; returns what its version is to be."""
        part, head, buckets = self._part(number), self.current() or Version(0), self._bucket_count(rows)
        version = replace(head, number=number, base=part, overlays=(), buckets=buckets, sizes={})
        self._write_docs(rows, part, buckets)
        if self.text_fields:
            self._write_counts(*self._counts(version), part, buckets)
        return version

    def _write_overlay(self, rows: DataFrame, number: int, replaced: DataFrame) -> None:
        """An overlay's counts are net of those of the rows it replaces (``words`` and ``terms``)."""
        self._write_docs(rows, number, None)
        if not self.text_fields:
            return
        terms, totals = self._counts(Version(0, None, (number,)))
        fields = self.text_fields
        old = replaced.withColumn("bucket", F.lit(OVERLAY))
        gone = P.set_statistics(old, fields, ("bucket",))
        less = P.field_statistics(old, fields, ("bucket",))
        terms = terms.unionByName(gone.withColumn("df", -F.col("df")), allowMissingColumns=True)
        totals = totals.unionByName(less.withColumns({c: -F.col(c) for c in ("n", "words")}))
        self._write_counts(*_summed(terms, totals), number, None)

    def _shape(self, rows: DataFrame) -> DataFrame:
        """Rows in the index schema; attributes the rows lack are null."""
        return rows.select(
            *[
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in self.schema
            ]
        )

    def convert(self) -> Version:
        """Register the index: an empty first version unless there is one already."""
        return self.current() or self.recreate()

    def recreate(self) -> Version:
        """A new, empty version with the present schema."""

        def attempt(head, number):
            head = head or Version(0)
            return self._publish(replace(head, number=number, base=None, overlays=(), buckets=1, sizes={}))

        return self._publishing(attempt)

    def clear(self) -> Version | None:
        """Recreate the index when it is enabled but not active yet."""
        if self.settings.enabled and not self.active:
            return self.recreate()
        return self.current()

    def rebuild(self, rows: DataFrame) -> Version:
        """Replace the whole index by ``rows``; what was published meanwhile is replaced too."""
        written = self._write_base(rows, self._head()[1])
        indexed = self._read("docs", "uid string", written).count()

        def attempt(head, number):
            applied = head.applied if head else {}
            totals = {"deleted_total": head.deleted_total, "queries_total": head.queries_total} if head else {}
            return self._publish(replace(written, number=number, applied=applied, **totals), indexed=indexed)

        return self._publishing(attempt)

    def merge(self) -> Version:
        """Fold the overlays: into one while they are small, else into a new base. A job of its
        own, for when overlays have grown to ``merge_after``; commits do not do it."""
        return self._publishing(self._merged)

    def _merged(self, version: Version, number: int) -> Version:
        if not version.overlays:
            return version
        overlays = replace(version, base=None)
        if version.base is None or overlays.bytes > self.settings.merge_share * version.bytes:
            return self._publish(replace(self._write_base(self.rows(version), number), applied=version.applied))
        part = self._part(number)
        rows = self._live(self._read("docs", self.schema, overlays), overlays)
        self._write_docs(rows, part, None)
        if self.text_fields:
            terms, totals = (self._read(t, s, overlays) for t, s in (("terms", _TERMS), ("fields", _FIELDS)))
            self._write_counts(*_summed(terms, totals), part, None)
        self._touched(version).select("uid").distinct().write.mode("overwrite").parquet(self._folder("touched", part))
        return self._publish(replace(version, number=number, overlays=(part,)))

    @property
    def crowded(self) -> bool:
        """Whether there are so many overlays that :meth:`merge` should run."""
        version = self.current()
        return version is not None and len(version.overlays) >= self.settings.merge_after

    def commit(self, compacted: DataFrame, batch_id: int | None = None, stream: str = "changes") -> Commit | None:
        """Apply pending actions as a new version, ``None`` if there is nothing to do.

        Batches of a stream are numbered upwards; one that is not above the last one published
        is skipped, so a replay changes nothing. If another writer publishes first, the actions
        are applied anew to what it left.
        """
        if not self.settings.enabled or self.current() is None:
            return None
        with Scratch(self.spark) as scratch:
            pending = scratch.write(compacted, "pending")

            def attempt(head, number):
                if batch_id is not None and batch_id <= head.applied.get(stream, -1):
                    return None
                applied = dict(head.applied) | ({stream: batch_id} if batch_id is not None else {})
                return self._apply(replace(head, applied=applied), number, pending, scratch)

            return self._publishing(attempt)

    def _apply(self, head: Version, number: int, compacted: DataFrame, scratch: Scratch) -> Commit | None:
        base = F.coalesce(F.col("base"), F.lit(""))
        summary = compacted.agg(
            F.count_if(base == "index").alias("indexed"),
            F.count_if((base != "index") & (F.size("attributes") > 0)).alias("updated"),
            F.count_if(base == "delete").alias("deleted"),
            F.count_if(base == "").alias("partial"),
            _buckets(head),
            _buckets(head, "partial_buckets", base == ""),
        ).first()
        if not summary["buckets"]:
            return None
        part = self._part(number)
        old = scratch.write(self._replaced(compacted, summary["buckets"], head), "replaced")
        refusals = self._folder("rejected", part)
        lost = rejected(old, compacted)
        lost.write.mode("overwrite").parquet(refusals)
        refused = self.spark.read.schema(lost.schema).parquet(refusals)

        # whole rows, with their texts, are only read where a part of them stays
        partial = compacted.where("base is null")
        kept = self.spark.createDataFrame([], self.schema)
        if summary["partial"]:
            kept = self.rows_of(partial, summary["partial_buckets"], head)
        self._write_overlay(apply_changes(kept, compacted), part, replaced=old)
        compacted.select("uid").write.mode("overwrite").parquet(self._folder("touched", part))
        counts = {name: summary[name] for name in ("indexed", "updated", "deleted")}
        newest = replace(head, number=number, overlays=(*head.overlays, part))
        newest = self._publish(newest, **counts, rejected=refused.count())
        return Commit(newest, **counts, refused=refused)

    def vacuum(self) -> None:
        """Delete the files of parts the newest version does not use.

        For when no reader holds an older version and no commit is running.
        """
        used = {f"v={part}" for part in self.current().parts}
        for table in ("docs", "postings", "terms", "fields", "touched", "rejected"):
            for name in file_names(self.spark, f"{self.path}/{table}"):
                if name.startswith("v=") and name not in used:
                    remove(self.spark, f"{self.path}/{table}/{name}")

    def describe(self) -> str:
        """Schema of the index as JSON, mapping metadata included."""
        return json.dumps(self.schema.jsonValue())


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("uid"), F.lit(buckets)).cast("int")


def _buckets(version: Version, name: str = "buckets", where: Column | None = None) -> Column:
    """Buckets of the rows at hand: at most as many values as the version has buckets."""
    bucket = _bucket(version.buckets)
    return F.collect_set(bucket if where is None else F.when(where, bucket)).alias(name)


def _dealt(rows: DataFrame, buckets: int, column: str, shards: int) -> DataFrame:
    """Rows with a ``bucket``, dealt by it and one of its ``shards``, by ``column``: a task for each
    ``_shard``. Hashes of the two would put several into one task and none into others."""
    own = F.pmod(F.hash(column), F.lit(shards))
    return rows.withColumn("_shard", F.col("bucket") * shards + own).repartitionById(buckets * shards, "_shard")


def _summed(terms: DataFrame, totals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signed counts of several overlays as those of one."""
    bucket = F.lit(OVERLAY).alias("bucket")
    terms = terms.groupBy(bucket, "field", "term", F.lit(0).alias("run")).agg(
        F.sum("df").alias("df"), F.max("tf").alias("tf"), F.min("len").alias("len")
    )
    # a word that only left counts less, and bounds nothing
    terms = terms.where("df <> 0 or tf is not null")
    totals = totals.groupBy(bucket, "field").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    return terms, totals


def _by_bucket(rows: DataFrame, path: str, page_rows: int | None = None, named: str | None = None) -> None:
    """Write ``rows`` in folders of their bucket. Row groups tell by a Bloom filter which values of
    ``named`` they hold, for look-ups of a column the rows are not sorted by."""
    writer = rows.write.mode("overwrite").partitionBy("bucket")
    if page_rows:
        writer = writer.option("parquet.page.row.count.limit", page_rows)
    if named:
        writer = writer.option(f"parquet.bloom.filter.enabled#{named}", "true")
        # as large as the values at hand need
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(path)
