"""Line dedup by content-defined chunks of lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.config import materialise
from findlark.llm.common import keyed, packed, ship, unpack

ship(__name__)

# Lines of a chunk, whose hashes are rolled into one; one such hash in so many begins a chunk.
WINDOW = 2
EVERY = 1
MIX = np.uint64(0x9E3779B97F4A7C15)


def chunks(text: str, window: int, every: int) -> list[tuple[int, int, int]]:
    """Chunks of a text: first line, line after the last, hash of the bytes.

    The hashes of ``window`` lines are rolled into one, line by line; a chunk of these lines begins
    wherever that hash is a multiple of ``every``. Whether it does is up to these lines alone, so
    equal passages are cut alike whatever stands around them, and with ``every`` = 1 no repeated
    pair of lines is missed. Chunks overlap; what joins up is one longer repeat. Chunks without a
    word are none.
    """
    import xxhash

    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    count = len(lines) - window + 1
    if count < 1:
        return []
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, lines), np.uint64, len(lines))
    rolled = np.zeros(count, np.uint64)
    for k in range(window):
        rolled = rolled * MIX + hashes[k : k + count]
    rolled = (rolled ^ (rolled >> np.uint64(29))) * MIX
    rolled ^= rolled >> np.uint64(32)
    begins = np.flatnonzero(rolled % np.uint64(every) == 0).tolist()
    filled = [bool(line.strip()) for line in lines]
    values = rolled.view(np.int64).tolist()
    return [(a, a + window, values[a]) for a in begins if any(filled[a : a + window])]


def repeated_chunks(docs: DataFrame, window: int, every: int) -> DataFrame:
    """Chunks that repeat those of an earlier document byte for byte: ``doc_id, text_key, hash``.

    Hashes are counted first, combined before the shuffle. Only chunks whose hash occurs in two
    documents are fetched, and each is compared with the bytes of the first one. Earlier is a
    smaller id; rows that share the smallest id all keep the chunk; a null id is last.
    """

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = [
                (ids[i], keys[i], h)
                for i, text in enumerate(batch.column(2))
                for h in {h for *_, h in chunks(text.as_py() or "", window, every)}
            ]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "text_key", "hash"]
                )

    rows = keyed(docs).select("doc_id", "text_key", "text")
    rows = materialise(rows.mapInArrow(narrow, "doc_id long, text_key long, hash long"), "chunks")
    rank = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    twice = rows.groupBy("hash").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = rows.join(twice.select("hash", "first"), "hash")
    wanted = shared.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("hash", (rank == F.col("first")).alias("first"))).alias("wanted")
    )

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text, of = unpack(row["_packed"], row["_size"]) or "", {w["hash"]: w["first"] for w in row["wanted"]}
                lines = text.split("\n")
                for a, b, h in chunks(text, window, every):
                    if h in of:
                        out.append((row["doc_id"], row["text_key"], h, of.pop(h), "\n".join(lines[a:b]).encode("utf-8", "surrogatepass")))
            if out:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], ["doc_id", "text_key", "hash", "first", "body"]
                )

    texts = packed(docs.select("doc_id", "text"))
    with_text = texts.join(wanted.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"}),
                           F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    found = with_text.select("doc_id", "text_key", "_packed", "_size", "wanted").mapInArrow(
        bodies, "doc_id long, text_key long, hash long, first boolean, body binary"
    )
    found = materialise(found, "bodies")
    firsts = found.where("first").groupBy("hash").agg(F.min("body").alias("_body"))
    later = found.where("not first").join(firsts, "hash").where("body = _body")
    return later.select("doc_id", "text_key", "hash")


def deduplicate(docs: DataFrame, window: int = WINDOW, every: int = EVERY) -> DataFrame:
    """``docs`` without repeated multi-line chunks, plus ``lines_before`` and ``lines_removed``.

    A text is split at ``\\n``; :func:`chunks` says which runs of ``window`` lines are chunks. A line
    goes if a chunk over it repeats, byte for byte, one of an earlier document (smaller id, null
    last), or an earlier one of the same text; the first stays. Chunks are judged on the input,
    overlaps count. What is left is joined by ``\\n`` again, in order; a text that lost every line
    is empty.

    Null text stays null; a text of fewer lines has no chunk. Rows repeated with the same id keep
    their chunks. No rows give no rows; other columns are passed on as they are, those called like
    helpers excepted (the pipeline folds them). Texts travel compressed and one document is held in
    a task at a time.
    """
    drop = repeated_chunks(docs, window, every)
    drop = drop.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.collect_set("hash").alias("_drop")
    )
    texts = packed(docs, carry=True)
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    joined = texts.join(drop, same, "left").drop("_id", "_key", "_doc", "text_key")
    new = ["lines_before", "lines_removed"]
    kept = [f for f in docs.schema.fields if f.name not in new]
    schema = T.StructType([*kept, *[T.StructField(n, T.LongType()) for n in new]])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, removed = [], [], []
            columns = [batch.column(batch.schema.get_field_index(n)) for n in ("_packed", "_size", "_drop")]
            for data, size, gone in zip(*columns):
                text, gone = unpack(data.as_py(), size.as_py()), set(gone.as_py() or ())
                lines = (text or "").split("\n")
                seen, dropped = set(), np.zeros(len(lines), bool)
                for a, b, h in chunks(text or "", window, every):
                    body = tuple(lines[a:b])
                    if h in gone or body in seen:
                        dropped[a:b] = True
                    seen.add(body)
                out = [line for line, d in zip(lines, dropped) if not d]
                texts.append(None if text is None else "\n".join(out))
                before.append(0 if text is None else len(lines))
                removed.append(0 if text is None else len(lines) - len(out))
            arrays = {"text": pa.array(texts, pa.string()), new[0]: pa.array(before, pa.int64()), new[1]: pa.array(removed, pa.int64())}
            yield pa.RecordBatch.from_arrays(
                [arrays[n] if n in arrays else batch.column(batch.schema.get_field_index(n)) for n in schema.names],
                schema.names,
            )

    return joined.mapInArrow(clean, schema)
