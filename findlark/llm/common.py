"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.config import materialise

# A word, in the sense of every contract of this folder: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Send the functions of a module to executors by value: they need not have it installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, none for null."""
    parts = F.split(F.coalesce(text, F.lit("")), GAP)
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words of a text as long, 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def running_sums(
    rows: DataFrame, order: Sequence[Column], values: Sequence[str], tag: str
) -> DataFrame:
    """Rows plus ``before_<value>`` columns: the sum of the value over all rows before, in order.

    A range-partitioned sort is written once with sums inside each partition; offsets are one
    row per partition. No task sees more than its own range. Values must be long.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    extra = [T.StructField("_part", T.IntegerType())]
    extra += [T.StructField(f"before_{v}", T.LongType()) for v in values]
    schema = T.StructType([*ordered.schema.fields, *extra])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        done = [0] * len(values)
        for batch in batches:
            columns = list(batch.columns)
            columns.append(pa.array(np.full(batch.num_rows, part, np.int32)))
            for k, value in enumerate(values):
                own = batch.column(batch.schema.get_field_index(value)).to_numpy(zero_copy_only=False)
                after = np.cumsum(own.astype(np.int64)) + done[k]
                columns.append(pa.array(after - own.astype(np.int64)))
                done[k] = int(after[-1]) if len(after) else done[k]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *[f.name for f in extra]])

    local = materialise(ordered.mapInArrow(add, schema), tag)
    sums = local.groupBy("_part").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, so this window and this broadcast stay small whatever the data
    offsets = sums.select(
        "_part", *[F.coalesce(F.sum(f"_sum_{v}").over(earlier), F.lit(0)).alias(f"_off_{v}") for v in values]
    )
    out = local.join(F.broadcast(offsets), "_part")
    for v in values:
        out = out.withColumn(f"before_{v}", F.col(f"before_{v}") + F.col(f"_off_{v}"))
    return out.drop("_part", *[f"_off_{v}" for v in values])


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now, not at the driver's next collection.

    Spark removes them when the driver's JVM finds a step unreachable; between large steps whose
    results have been written that is worth asking for.
    """
    gc.collect()
    spark._jvm.System.gc()


def batches_of(
    batches: Iterator[pa.RecordBatch], column: str, limit: int
) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches whose strings or bytes in ``column`` sum to about ``limit`` bytes.

    A single longer row is a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        sizes = np.array([0 if v is None else v for v in pa.compute.binary_length(values).to_pylist()])
        ends = np.cumsum(sizes)
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the id as long and ``text_key``, a hash that tells texts of one id apart."""
    return docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text_key", F.xxhash64("text"))


def packed(docs: DataFrame, carry: bool = False) -> DataFrame:
    """``docs`` with the text as compressed bytes ``_packed`` of ``_size``, for joins by id.

    With ``carry`` all other columns come along and the id is repeated as ``_doc``; without, the
    result is ``doc_id, text_key, _packed, _size``.
    """
    rows = docs.withColumn("text_key", F.xxhash64("text"))
    if carry:
        rows = rows.withColumn("_doc", F.col("doc_id").cast("long"))
    else:
        rows = rows.select(F.col("doc_id").cast("long"), "text_key", "text")
    kept = [f for f in rows.schema.fields if f.name != "text"]
    added = [T.StructField("_packed", T.BinaryType()), T.StructField("_size", T.LongType())]
    schema = T.StructType([*kept, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            texts = [t.as_buffer() for t in batch.column(batch.schema.get_field_index("text"))]
            data = pa.array([None if t is None else codec.compress(t, asbytes=True) for t in texts], pa.binary())
            sizes = pa.array([0 if t is None else t.size for t in texts], pa.int64())
            own = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*own, data, sizes], schema.names)

    return rows.mapInArrow(run, schema)


def unpack_bytes(data: bytes | None, size: int) -> bytes:
    return b"" if data is None or not size else pa.Codec("zstd").decompress(data, size, asbytes=True)


def unpack(data: bytes | None, size: int) -> str | None:
    """The text :func:`packed` compressed."""
    return None if data is None else unpack_bytes(data, size).decode("utf-8", "surrogatepass")
