"""Exact substring dedup: longest previous factors over a sparse suffix order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.config import materialise
from findlark.llm.common import packed, release, ship, unpack_bytes

ship(__name__)

LENGTH = 100
GRAM = 32
# bytes scanned at once and bytes of blocks ordered at once: bounds of a task's memory
SCAN_BYTES = 1 << 18
ORDER_BYTES = 1 << 19
# windows of one block at most, and so bytes that a kind of block carries
RUN = 256
# a key with more distinct blocks than this is compared window by window, spread by their hash
HOT = 2048
LAST = (1 << 63) - 1

_rng = np.random.Generator(np.random.Philox(key=[7, 11]))
LETTERS = _rng.integers(0, 1 << 63, 256, np.uint64)
BASE = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values."""
    span = 1
    while 2 * span <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


@dataclass
class Blocks:
    """Runs of windows with the same key: owner document, first and last window, key; and
    whether the key's gram is selected again in its document."""

    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    key: np.ndarray
    again: np.ndarray


def picked(blocks: Blocks, which: np.ndarray) -> Blocks:
    return Blocks(*(getattr(blocks, name)[which] for name in ("doc", "first", "last", "key", "again")))


def segment(
    letters: np.ndarray, owner: np.ndarray, length: int, gram: int, repeats: bool
) -> tuple[np.ndarray, ...]:
    """Of the windows that lie in ``letters`` and in one document: first and last of each block,
    its key; with ``repeats`` also the places of the grams chosen as keys, and the grams."""
    hashes, power, span = LETTERS[letters], BASE, 1
    with np.errstate(over="ignore"):
        while span < gram:
            hashes = hashes[:-span] * power + hashes[span:]
            power, span = power * power, 2 * span
        grams = mixed(hashes).view(np.int64)
    width = length - gram + 1
    least = sliding(grams, width, np.minimum)
    count = len(least)
    inside = owner[:count] == owner[length - 1 :]
    start = inside.copy()
    start[1:] &= (least[1:] != least[:-1]) | ~inside[:-1] | (owner[1:count] != owner[: count - 1])
    # a long run, of periodic text, is several blocks
    begun = np.maximum.accumulate(np.where(start, np.arange(count), 0))
    start |= inside & ((np.arange(count) - begun) % RUN == 0)
    stop = inside.copy()
    stop[:-1] &= start[1:] | ~inside[1:]
    first, last = np.flatnonzero(start), np.flatnonzero(stop)
    if not repeats:
        return first, last, least[first], first[:0], grams[:0]
    # a gram is chosen if it is the smallest of a window it lies in
    low = np.where(inside, least, np.iinfo(np.int64).min)
    edge = np.full(width - 1, np.iinfo(np.int64).min)
    highest = sliding(np.concatenate([edge, low, edge]), width, np.maximum)[: len(grams)]
    chosen = np.flatnonzero(grams == highest)
    return first, last, least[first], chosen, grams[chosen]


def scan(data: bytes, sizes: np.ndarray, length: int, gram: int, repeats: bool = False) -> Blocks:
    """Blocks of documents that lie one after another in ``data``.

    A window of ``length`` bytes has as key the smallest hash of its grams, so equal windows have
    equal keys wherever they stand; windows of neighbouring starts mostly share it. Long data is
    scanned in segments that overlap by a window. ``again`` is only found with ``repeats``.
    """
    letters = np.frombuffer(data, np.uint8)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    step = max(SCAN_BYTES, length)
    parts = []
    for at in range(0, max(1, len(letters) - length + 1), 2 * step):
        end = min(len(letters), at + 2 * step + length - 1)
        if end - at >= length:
            found = segment(letters[at:end], owner[at:end], length, gram, repeats)
            parts.append((found[0] + at, found[1] + at, found[2], found[3] + at, found[4]))
    if not parts:
        empty = np.zeros(0, np.int64)
        return Blocks(empty, empty, empty, empty, empty.astype(bool))
    first, last, key, chosen, grams = (np.concatenate(x) for x in zip(*parts))
    doc, chosen_doc = owner[first].astype(np.int64), owner[chosen].astype(np.int64)
    order = np.lexsort((grams, chosen_doc))
    a, b = grams[order], chosen_doc[order]
    twice = np.zeros(len(a), bool)
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    twice[1:] |= same
    twice[:-1] |= same
    repeated = {(d, k) for d, k in zip(b[twice].tolist(), a[twice].tolist())}
    again = np.zeros(len(doc), bool)
    if repeated:
        again = np.isin(doc, list({d for d, _ in repeated}))
        again[again] = [(d, k) in repeated for d, k in zip(doc[again].tolist(), key[again].tolist())]
    return Blocks(doc, first, last, key, again)


def signatures(data: bytes, blocks: Blocks, length: int) -> np.ndarray:
    """Hash of the bytes of all windows of each block; equal blocks have equal windows."""
    import xxhash

    view, digest = memoryview(data), xxhash.xxh64_intdigest
    ends = (blocks.last + length).tolist()
    made = (digest(view[a:b]) for a, b in zip(blocks.first.tolist(), ends))
    return np.fromiter(made, np.uint64, len(ends)).view(np.int64)


def groups(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together; a longer one is alone."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > limit:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def dense(values: np.ndarray) -> np.ndarray:
    """Rank of each value among the distinct ones."""
    order = np.argsort(values)
    ordered = values[order]
    step = np.zeros(len(values), np.int64)
    np.cumsum(ordered[1:] != ordered[:-1], out=step[1:])
    ranks = np.empty(len(values), np.int64)
    ranks[order] = step
    return ranks


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of every suffix in suffix order, suffixes cut off after ``length`` bytes: equal ranks
    mean a common prefix of ``length`` bytes. Prefix doubling from words of eight bytes."""
    size, span = len(data), 8
    word = np.zeros(size, np.uint64)
    padded = np.concatenate([data, np.zeros(length, np.uint8)]).astype(np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k : k + size]
    rank = dense(word)
    while span < length:
        step = min(span, length - span)
        # the second half may overlap the first: both prefixes together cover span + step bytes
        later = np.concatenate([rank[step:], np.zeros(step, np.int64)])
        rank = dense(rank * (size + 1) + later)
        span += step
    return rank


def previous(ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Place of the earliest suffix with the same cut-off rank, for each suffix.

    This is the longest-previous-factor rule cut off at the length asked for. In suffix order,
    ties by place, the suffixes that share ``length`` bytes with one are its neighbours of equal
    rank; its previous smaller place is the neighbour before it, and there is no smaller place
    after it inside the run. So its longest previous factor reaches the length exactly if it is
    not the first of its run, and the first of the run is its earliest match.
    """
    order = np.lexsort((places, ranks))
    sorted_ranks = ranks[order]
    head = np.concatenate([[True], sorted_ranks[1:] != sorted_ranks[:-1]])
    first = places[order][np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    out = np.empty_like(places)
    out[order] = first
    return out


def own_repeats(data: bytes, blocks: Blocks, length: int) -> np.ndarray:
    """Starts of windows that occur earlier in the same document."""
    pick = np.flatnonzero(blocks.again)
    if not len(pick):
        return np.zeros(0, np.int64)
    letters = np.frombuffer(data, np.uint8)
    first, last, doc = blocks.first[pick], blocks.last[pick], blocks.doc[pick]
    size = last - first + length
    base = np.concatenate([[0], np.cumsum(size)])
    text_at = np.arange(base[-1]) - np.repeat(base[:-1] - first, size)
    ranks = suffix_ranks(letters[text_at], length)
    offset = np.arange(base[-1]) - np.repeat(base[:-1], size)
    window = offset <= np.repeat(last - first, size)
    places, ranks = text_at[window], ranks[window]
    of = np.repeat(doc, size)[window]
    # one document's suffixes at a time: the document leads the rank
    found = previous(of * (len(letters) + 1) + ranks, places)
    return np.sort(places[found < places])


def later_windows(key: np.ndarray, rank: np.ndarray, body: list[bytes], length: int) -> list[np.ndarray]:
    """For each block, the offsets of its windows that occur in a block of smaller rank."""
    sizes = np.array([len(b) for b in body])
    data = np.frombuffer(b"".join(body), np.uint8)
    base = np.concatenate([[0], np.cumsum(sizes)])
    ranks = suffix_ranks(data, length)
    owner = np.repeat(np.arange(len(body)), sizes)
    offset = np.arange(len(data)) - base[owner]
    window = offset <= sizes[owner] - length
    owner, offset, ranks = owner[window], offset[window], ranks[window]
    later = previous(ranks, rank[owner]) < rank[owner]
    owner, offset = owner[later], offset[later]
    cuts = np.searchsorted(owner, np.arange(len(body) + 1))
    return [offset[a:b] for a, b in zip(cuts, cuts[1:])]


def runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by windows at the given ascending starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] > starts[:-1] + length) + 1
    return list(zip(starts[np.concatenate([[0], cut])].tolist(), (starts[np.append(cut - 1, len(starts) - 1)] + length).tolist()))


def compared(docs: DataFrame, length: int, gram: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """What happens to repeated blocks: ``doc_id, key, sig, state``, and how many distinct blocks
    compared keys have. State 1: an earlier document has the same block. State 2: the first of
    its kind, but other blocks have its key, so its windows must be compared."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"))

    def emit(with_sig: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, data = batch.column(0), batch.column(1).to_pylist()
                for a, b in groups(data, SCAN_BYTES):
                    whole = b"".join(data[a:b])
                    blocks = scan(whole, np.array([len(x) for x in data[a:b]]), length, gram)
                    columns = [pa.array(blocks.key)]
                    if with_sig:
                        columns += [pa.array(signatures(whole, blocks, length)), ids.slice(a, b - a).take(pa.array(blocks.doc))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "sig", "doc_id"][: len(columns)])

        return run

    keys = texts.mapInArrow(emit(False), "key long").groupBy("key").count().where("count > 1").select("key")
    keys = materialise(keys, "keys")
    release(spark)
    blocks = texts.mapInArrow(emit(True), "key long, sig long, doc_id long").join(keys, "key")
    blocks = materialise(blocks, "blocks")
    release(spark)
    rank = F.coalesce("doc_id", F.lit(LAST))
    kinds = materialise(blocks.groupBy("key", "sig").agg(F.min(rank).alias("first"), F.count("*").alias("n")), "kinds")
    several = materialise(kinds.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1"), "several")
    # kinds of which nothing is left to do are left out of the join with their blocks
    wanted = kinds.join(several, "key", "left").where("n > 1 or kinds is not null")
    wanted = wanted.select("key", "sig", "first", (F.col("kinds").isNotNull()).alias("more"))
    state = F.when(rank > F.col("first"), 1).when(F.col("more"), 2)
    states = blocks.join(wanted, ["key", "sig"]).select("doc_id", "key", "sig", state.alias("state"))
    states = materialise(states.where("state is not null").distinct(), "states")
    release(spark)
    return states, several.select("key", (F.col("kinds") > hot).alias("hot"))


def by_document(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per document: arrays of the columns, bounded by the document."""
    return rows.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list(F.struct(*columns)).alias("marks"))


def window_states(docs: DataFrame, states: DataFrame, several: DataFrame, length: int, gram: int) -> DataFrame:
    """Windows of compared blocks that an earlier document has: ``doc_id, key, sig, offsets``."""

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            texts = [unpack_bytes(row["_packed"], row["_size"]) for row in rows]
            for a, b in groups(texts, SCAN_BYTES):
                whole = b"".join(texts[a:b])
                blocks = scan(whole, np.array([len(x) for x in texts[a:b]]), length, gram)
                wanted = [{(m["key"], m["sig"]) for m in row["marks"]} for row in rows[a:b]]
                keys = np.array(list({k for w in wanted for k, _ in w}))
                own = picked(blocks, np.flatnonzero(np.isin(blocks.key, keys)))
                out = {}
                found = zip(own.doc.tolist(), own.key.tolist(), signatures(whole, own, length).tolist(), own.first.tolist(), own.last.tolist())
                for i, k, s, first, last in found:
                    if (k, s) in wanted[i]:
                        out[(i, k, s)] = whole[first : last + length]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([rows[a + i]["doc_id"] for i, _, _ in out], pa.int64()),
                        pa.array([k for _, k, _ in out], pa.int64()),
                        pa.array([s for _, _, s in out], pa.int64()),
                        pa.array(list(out.values()), pa.binary()),
                    ],
                    ["doc_id", "key", "sig", "body"],
                )

    marks = by_document(states.where("state = 2"), "key", "sig")
    texts = packed(docs.select("doc_id", "text")).join(marks, F.col("doc_id").eqNullSafe(F.col("_id")))
    texts = texts.select("doc_id", "_packed", "_size", "marks")
    bodies_of = texts.mapInArrow(bodies, "doc_id long, key long, sig long, body binary").join(several, "key")
    bodies_of = materialise(bodies_of, "block-bytes")
    release(docs.sparkSession)

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Orders the suffixes of whole keys, as many as fit, together."""

        def flush(rows: list[dict]):
            rank = np.array([LAST if r["doc_id"] is None else r["doc_id"] for r in rows])
            found = later_windows(np.array([r["key"] for r in rows]), rank, [r["body"] for r in rows], length)
            hit = [k for k, f in enumerate(found) if len(f)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[k]["doc_id"] for k in hit], pa.int64()),
                    pa.array([rows[k]["key"] for k in hit], pa.int64()),
                    pa.array([rows[k]["sig"] for k in hit], pa.int64()),
                    pa.array([found[k].tolist() for k in hit], pa.list_(pa.int32())),
                ],
                ["doc_id", "key", "sig", "offsets"],
            )

        held, total = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if held and total > ORDER_BYTES and row["key"] != held[-1]["key"]:
                    yield from flush(held)
                    held, total = [], 0
                held.append(row)
                total += len(row["body"])
        if held:
            yield from flush(held)

    cold = bodies_of.where("not hot").drop("hot").repartition("key").sortWithinPartitions("key")
    cold = cold.mapInArrow(order, "doc_id long, key long, sig long, offsets array<int>")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for row in batch.to_pylist():
                view = memoryview(row["body"])
                made = [xxhash.xxh64_intdigest(view[i : i + length]) for i in range(len(view) - length + 1)]
                for at in range(0, len(made), 1 << 14):
                    part = np.array(made[at : at + (1 << 14)], np.uint64).view(np.int64)
                    same = [np.full(len(part), v) for v in (row["key"], row["sig"])]
                    ids = pa.array([row["doc_id"]] * len(part), pa.int64())
                    places = pa.array(np.arange(at, at + len(part), dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(same[0]), pa.array(same[1]), pa.array(part), places],
                        ["doc_id", "key", "sig", "window", "offset"],
                    )

    # hot keys: the same comparison one window at a time, combined before the shuffle
    hot = bodies_of.where("hot").mapInArrow(split, "doc_id long, key long, sig long, window long, offset int")
    rank = F.coalesce("doc_id", F.lit(LAST))
    firsts = hot.groupBy("key", "window").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = hot.join(firsts, ["key", "window"]).where(rank > F.col("first"))
    warm = later.groupBy("doc_id", "key", "sig").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))
    return materialise(cold.unionByName(warm), "windows")


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every document.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document
    with a smaller id, or earlier in the same one. Strings are judged on the input.

    Keys cut each document into blocks of windows (see :func:`scan`); a window can only recur in
    a block of the same key. Keys are counted, blocks of keys that recur are grouped by content,
    and of equal blocks all but the earliest go whole. Of the rest, blocks that share a key with
    others are laid side by side, their suffixes put in order, and every window with a previous
    factor of ``length`` bytes in an earlier document goes (:func:`previous`). A key with more
    than ``hot`` distinct blocks is compared by window hashes instead, spread over all tasks.
    Repeats inside one document are found the same way within its own suffixes.

    Null text is empty; nothing shorter than ``length`` bytes is touched; a null id comes last.
    Rows that share an id are neither earlier nor later than each other. No rows give no rows;
    other columns are left out. ``kept`` holds the remaining bytes, which may cut a character in
    two. Texts travel compressed; a task holds one document or about a quarter megabyte.
    """
    states, several = compared(docs, length, gram, hot)
    windows = window_states(docs, states, several, length, gram)
    release(docs.sparkSession)
    whole = states.where("state = 1").select("doc_id", "key", "sig", F.lit(None).cast("array<int>").alias("offsets"))
    marks = by_document(whole.unionByName(windows), "key", "sig", "offsets")
    texts = packed(docs.select("doc_id", "text")).join(marks, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    texts = texts.select("doc_id", "_packed", "_size", "marks")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
            ("kept_sha256", pa.string()), ("kept", pa.binary()),
        ])
        for batch in batches:
            out = []
            rows = batch.to_pylist()
            bodies = [unpack_bytes(row["_packed"], row["_size"]) for row in rows]
            for a, b in groups(bodies, SCAN_BYTES):
                whole, sizes = b"".join(bodies[a:b]), np.array([len(x) for x in bodies[a:b]])
                blocks = scan(whole, sizes, length, gram, True)
                gone = own_repeats(whole, blocks, length)
                cuts = np.searchsorted(blocks.doc, np.arange(b - a + 1))
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                for i in range(a, b):
                    base, end = int(bounds[i - a]), int(bounds[i - a + 1])
                    starts = [gone[np.searchsorted(gone, base) : np.searchsorted(gone, end)]]
                    marks = {(m["key"], m["sig"]): m["offsets"] for m in rows[i]["marks"] or ()}
                    if marks:
                        own = slice(cuts[i - a], cuts[i - a + 1])
                        pick = np.flatnonzero(np.isin(blocks.key[own], np.array([k for k, _ in marks]))) + own.start
                        some = picked(blocks, pick)
                        sigs = signatures(whole, some, length)
                        for k, s, f, e in zip(some.key.tolist(), sigs.tolist(), some.first.tolist(), some.last.tolist()):
                            if (k, s) in marks:
                                at = marks[(k, s)]
                                starts.append(np.arange(f, e + 1) if at is None else f + np.array(at, np.int64))
                    spans = runs(np.unique(np.concatenate(starts)), length)
                    kept, done = [], base
                    for x, y in spans:
                        kept.append(whole[done:x])
                        done = y
                    kept = b"".join([*kept, whole[done:end]])
                    out.append((
                        rows[i]["doc_id"], end - base, end - base - len(kept), len(spans),
                        hashlib.sha256(kept).hexdigest(), kept,
                    ))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return texts.mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s FROM d, unnest(range(0, n - 99)) r(p)),
later AS (
  SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1),
marked AS (
  SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100, true)::INT AS new FROM later),
numbered AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM marked),
spans AS (SELECT doc_id, k, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY ALL),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER o, 0) AS x, a AS y FROM spans WINDOW o AS (PARTITION BY doc_id ORDER BY k)
  UNION ALL SELECT doc_id, coalesce(max(b), 0), any_value(n) FROM d LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(h, (2 * x + 1)::BIGINT, (2 * (y - x))::BIGINT), '' ORDER BY x) AS h
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
totals AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN totals USING (doc_id)
"""
