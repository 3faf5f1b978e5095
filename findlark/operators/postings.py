"""Positional postings and their statistics, built without shuffling single words."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.functions.text import joined_tokens, tokens

# executors need not have this module installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

K1 = 1.2
B = 0.75
# postings of a word in its first run, in one bucket and shard, and how much longer each next run is
RUN = 64
RUN_GROWTH = 4
# text that a task takes apart: its words, a row each until they are grouped, are sorted in memory
TASK_BYTES = 1 << 22
# texts of a task that are taken apart together, as a multiple of those it should have
CHUNK = 2
# rows of postings that are handed on at once
BATCH_ROWS = 1 << 15
# bytes of words: ASCII letters, digits and underscore, and those of other letters and numbers
_LETTERS = np.array([b > 127 or chr(b).isalnum() or chr(b) == "_" for b in range(256)])


def with_words(docs: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Documents with two struct columns of their text fields: ``words``, how many there are, and ``terms``,
    which, in order: what a document counts for, without its text."""
    found = docs.withColumn("_tokens", F.struct(*[tokens(F.col(name)).alias(name) for name in fields]))
    counts = [F.size(f"_tokens.{name}").alias(name) for name in fields]
    sets = [F.sort_array(F.array_distinct(f"_tokens.{name}")).alias(name) for name in fields]
    return found.withColumns({"words": F.struct(*counts), "terms": F.struct(*sets)}).drop("_tokens")


def tasks(docs: DataFrame, fields: Sequence[str]) -> int:
    """Tasks among which the texts are dealt, one for every :data:`TASK_BYTES`; scans the texts once."""
    sizes = [F.coalesce(F.octet_length(name).cast("long"), F.lit(0)) for name in fields]
    total = docs.agg(F.sum(reduce(add, sizes)).alias("n")).first()["n"] if sizes else 0
    return 1 + (total or 0) // TASK_BYTES


def build_postings(
    docs: DataFrame, fields: Sequence[str], keys: Sequence[str] = ("uid",), *, clustered: bool = False
) -> DataFrame:
    """``(keys, field, term, tf, len, positions)``, one row per document and word; ``len`` counts
    the words of the field.

    The texts are hash-partitioned by ``keys`` before they are taken apart, so what is
    shuffled is text and each document is inverted where it lies, in as many partitions as
    :func:`tasks` says, so a task's words do not grow with the table. ``clustered`` says that
    ``docs`` is partitioned by some of ``keys`` already.
    """
    if not clustered:
        docs = docs.select(*keys, *fields).repartition(tasks(docs, fields), *keys)
    # one pass over the documents, not a union that reads them once per field
    words = F.array(
        *[F.struct(F.lit(name).alias("field"), tokens(F.col(name)).alias("words")) for name in fields]
    )
    per_field = docs.select(*keys, F.explode(words).alias("part"))
    exploded = per_field.select(
        *keys,
        F.col("part.field").alias("field"),
        F.size("part.words").alias("len"),
        F.posexplode("part.words").alias("position", "term"),
    )
    grouped = exploded.groupBy(*keys, "field", "len", "term").agg(
        F.sort_array(F.collect_list("position")).alias("positions")
    )
    return grouped.select(*keys, "field", "term", F.size("positions").alias("tf"), "len", "positions")


def inverted(
    docs: DataFrame, fields: Sequence[str], keys: Sequence[str], means: Mapping[str, float | None] | None = None
) -> DataFrame:
    """:func:`build_postings` of documents that are partitioned by some of ``keys`` already, with the ``run``
    of each row: ``(keys, field, term, run, tf, len, positions)``.

    The best :data:`RUN` postings of a word are run 0, then each run is :data:`RUN_GROWTH` times as long
    as the one before. ``means`` has the mean words of fields. It only decides how well runs sort
    documents; bounds come from what is in a run. Without it there is one run.

    Nothing is shuffled: :data:`CHUNK` times the texts of a task, all it has unless a text is
    long, are taken apart together, and runs are those of these. Their rows come out by field, word, run and
    worth, so that little is left to do for a sort by these.
    """
    texts = [F.encode(joined_tokens(F.col(name)), "UTF-8").alias(f"_text{i}") for i, name in enumerate(fields)]
    # rows of one document follow each other
    texts = docs.select(*keys, *texts).sortWithinPartitions(*keys)
    found = T.StructType.fromDDL("field string, term string, run int, tf int, len int, positions array<int>")
    schema = T.StructType([*[texts.schema[key] for key in keys], *found])
    size, count, names = CHUNK * TASK_BYTES, len(keys), sorted((name, i) for i, name in enumerate(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _documents(batches, count, size):
            for name, i in names:
                mean = None if means is None else means.get(name) or 1.0
                yield from _inverted(rows, count, i, name, schema.names, mean)

    return texts.mapInArrow(run, schema)


def _same_as_before(rows: pa.Table, count: int) -> np.ndarray:
    """Whether the first columns of a row are those of the row before it; null is like null."""
    same = np.ones(max(0, rows.num_rows - 1), bool)
    for i in range(count):
        column = rows.column(i).combine_chunks()
        before, after = column.slice(0, len(same)), column.slice(1)
        equal = pc.fill_null(pc.equal(before, after), False).to_numpy(zero_copy_only=False)
        none = pc.and_(before.is_null(), after.is_null()).to_numpy(zero_copy_only=False)
        same &= equal | none
    return np.concatenate([[False], same])[: rows.num_rows]


def _documents(batches: Iterator[pa.RecordBatch], count: int, size: int) -> Iterator[pa.Table]:
    """Tables of about ``size`` bytes; no two hold the same first ``count`` columns."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        # a batch may hold long texts
        step = max(1, batch.num_rows * size // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, step):
            kept.append(batch.slice(start, step))
            if sum(b.nbytes for b in kept) < size:
                continue
            rows = pa.Table.from_batches(kept)
            new = np.flatnonzero(~_same_as_before(rows, count))
            whole = int(new[-1])
            if whole:
                yield rows.slice(0, whole)
            kept = rows.slice(whole).to_batches()
    if kept:
        yield pa.Table.from_batches(kept)


def _inverted(
    rows: pa.Table, count: int, which: int, field: str, names: list[str], mean: float | None
) -> Iterator[pa.RecordBatch]:
    """Postings of one field, whose words lie between spaces, or other ASCII characters that no word has."""
    texts = rows.column(count + which).to_pylist()
    data = np.frombuffer(b" ".join(texts), np.uint8)
    letter = np.zeros(len(data) + 2, bool)
    letter[1:-1] = _LETTERS[data]
    edges = np.flatnonzero(letter[1:] != letter[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return
    ends = np.cumsum([len(t) + 1 for t in texts])
    row = np.searchsorted(ends, starts, side="right")
    words = np.bincount(row, minlength=len(texts))
    position = np.arange(len(row)) - (np.cumsum(words) - words)[row]
    # rows with the same keys and as many words are one document
    owner = np.cumsum(~_same_as_before(rows, count))
    kinds, first, unit = np.unique((owner << 32) | words, return_index=True, return_inverse=True)
    spelled = pa.Array.from_buffers(
        pa.binary(), len(starts),
        [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.py_buffer(data[letter[1:-1]])],
    ).dictionary_encode()
    order = pc.sort_indices(spelled.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    key = rank[spelled.indices.to_numpy()] * len(kinds) + unit[row]
    by = np.lexsort((position, key)) if len(kinds) < len(texts) else np.argsort(key, kind="stable")
    key, position = key[by], position[by].astype(np.int32)
    at = np.flatnonzero(np.diff(key, prepend=-1))
    tf, term, doc = np.diff(np.append(at, len(key))), key[at] // len(kinds), key[at] % len(kinds)
    length = words[first[doc]]
    lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(key)).astype(np.int32)), pa.array(position))
    runs = np.zeros(len(at), np.int32)
    if mean is not None:
        best = np.lexsort((doc, -saturation(tf, length, mean), term))
        tf, term, doc, length, lists = tf[best], term[best], doc[best], length[best], lists.take(pa.array(best))
        new = np.flatnonzero(np.diff(term, prepend=-1))
        place = np.arange(len(term)) - np.repeat(new, np.diff(np.append(new, len(term))))
        longer = np.floor(np.log(np.maximum(place, RUN) / RUN) / np.log(RUN_GROWTH)).astype(np.int32) + 1
        runs = np.where(place < RUN, 0, longer).astype(np.int32)
    columns = [
        *(rows.column(i).combine_chunks().take(pa.array(first[doc])) for i in range(count)),
        pa.repeat(field, len(at)), spelled.dictionary.take(order).cast(pa.string()).take(pa.array(term)),
        pa.array(runs), pa.array(tf.astype(np.int32)), pa.array(length.astype(np.int32)), lists,
    ]
    found = pa.RecordBatch.from_arrays(columns, names)
    for k in range(0, found.num_rows, BATCH_ROWS):
        yield found.slice(k, BATCH_ROWS)


def saturation(tf: Column | np.ndarray, length: Column | np.ndarray, mean: Column | float) -> Column | np.ndarray:
    """BM25's part of a word that comes ``tf`` times in a field of ``length`` words."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def term_statistics(postings: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Documents per word."""
    return postings.groupBy(*keys, "field", "term").agg(F.count("*").alias("df"))


def run_statistics(postings: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Documents per word and run, by powers of two of the word's frequency: ``df``, the greatest
    ``tf`` and the least ``len``. No posting of such a row scores more than these two would."""
    step = F.floor(F.log2(F.col("tf"))).cast("int").alias("step")
    rows = postings.groupBy(*keys, "field", "term", "run", step)
    return rows.agg(F.count("*").alias("df"), F.max("tf").alias("tf"), F.min("len").alias("len")).drop("step")


def set_statistics(docs: DataFrame, fields: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Documents per word from the ``terms`` column of :func:`with_words`."""
    sets = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f"terms.{f}").alias("words")) for f in fields]
    )
    rows = docs.select(*keys, F.explode(sets).alias("part"))
    rows = rows.select(*keys, F.col("part.field").alias("field"), F.explode("part.words").alias("term"))
    return rows.groupBy(*keys, "field", "term").agg(F.count("*").alias("df"))


def field_statistics(docs: DataFrame, fields: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Documents with at least one word, and words, per field, from the ``words`` column."""
    sizes = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f"words.{f}").alias("size")) for f in fields]
    )
    rows = docs.select(*keys, F.explode(sizes).alias("part"))
    return rows.groupBy(*keys, F.col("part.field").alias("field")).agg(
        F.count_if(F.col("part.size") > 0).alias("n"), F.sum("part.size").alias("words")
    )
