"""SimHash near-duplicates by a self-join of binary tries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findlark.config import materialise
from findlark.llm.common import ship
from findlark.llm.graph import components

ship(__name__)

SHINGLE = 3
SEED = 42
BUDGET = 3
# Tries of more fingerprints than this are split again. Node pairs that are open at once.
TRIE = 1024
OPEN = 1 << 19
# Bits a bucket fixes at each split: a quarter of those left. After the last one, 16 are left.
WIDTHS = (16, 12, 9, 6, 5)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as a signed 64-bit number, 0 without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([digest(line, SEED)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[:-1]])
        pairs = zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist())
        hashes = np.fromiter((digest(line[a:b], SEED) for a, b in pairs), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, a hash ``text_key`` of the text, and ``fp`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(text.as_py(), shingle) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.int64())], ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def bucket_keys(fps: np.ndarray, level: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys of the next level: each fingerprint under each quarter of its free bits.

    Two fingerprints that differ in at most three bits, none of them fixed so far, agree on one
    of the four disjoint quarters whole, so they meet under it. ``keys`` tell which quarters were fixed.
    """
    count = len(fps)
    free = np.broadcast_to(np.arange(64), (count, 64))
    shift = 0
    for width in WIDTHS[: level - 1]:
        quarter = (keys >> shift) & 3
        left = free.shape[1]
        # the free bits without the quarter that the key fixes
        first = quarter * left // 4
        at = np.arange(left - width)
        free = np.take_along_axis(free, at + width * (at >= first[:, None]), axis=1)
        shift += 2 + width
    width, left = WIDTHS[level - 1], free.shape[1]
    wide = fps.astype(np.uint64)
    rows, made = [], []
    for quarter in range(4):
        first = quarter * left // 4
        value = np.zeros(count, np.int64)
        for k in range(width):
            value |= (((wide >> free[:, first + k].astype(np.uint64)) & np.uint64(1)).astype(np.int64)) << k
        rows.append(np.arange(count))
        made.append(keys | (np.int64(quarter) << shift) | (value << (shift + 2)))
    return np.concatenate(rows), np.concatenate(made)


def dealt(rows: DataFrame, level: int) -> DataFrame:
    """Buckets of one level, ``key, fp``, from those of the level before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 1 << 14) for at in range(0, batch.num_rows, 1 << 14)):
                keys, fps = (part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                which, made = bucket_keys(fps, level, keys)
                yield pa.RecordBatch.from_arrays([pa.array(made), pa.array(fps[which])], ["key", "fp"])

    return rows.mapInArrow(run, "key long, fp long")


def trie_pairs(keys: np.ndarray, fps: np.ndarray, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of the same key whose fingerprints differ in at most ``budget`` bits, joined
    into one tree per group of linked rows: (row, smallest row of its group).

    Rows are sorted by key and fingerprint, so a trie node is a run of rows. Pairs of nodes go
    down together, bit by bit; the bits in which their paths differ are counted, and a pair over
    the budget is dropped with all that lies below it. Two single rows are compared at once.
    """
    fps = fps.astype(np.uint64)
    change = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    ends = np.append(change[1:], len(keys))
    big = ends - change > 1
    label = np.arange(len(fps))

    def join(i: np.ndarray, j: np.ndarray) -> None:
        """Point the smallest rows of linked groups at each other until nothing moves."""
        while len(i):
            low, high = label[i], label[j]
            open_ = low != high
            i, j, low, high = i[open_], j[open_], low[open_], high[open_]
            if not len(i):
                break
            np.minimum.at(label, np.maximum(low, high), np.minimum(low, high))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up

    ones: dict[int, np.ndarray] = {}
    zero = np.zeros(int(big.sum()), np.int64)
    stack = [(0, change[big], ends[big], change[big], ends[big], zero)]
    while stack:
        depth, lo1, hi1, lo2, hi2, differ = stack.pop()
        single = (hi1 - lo1 == 1) & (hi2 - lo2 == 1)
        if single.any():
            i, j = lo1[single], lo2[single]
            near = (i != j) & (np.bitwise_count(fps[i] ^ fps[j]) <= budget)
            join(i[near], j[near])
            lo1, hi1, lo2, hi2, differ = (x[~single] for x in (lo1, hi1, lo2, hi2, differ))
        if not len(lo1):
            continue
        if depth == 64:
            # equal fingerprints in runs: rows are distinct, so only hand-made input comes here
            for a, b, c, d in zip(lo1, hi1, lo2, hi2):
                join(np.arange(a, b), np.full(b - a, c))
                join(np.arange(c, d), np.full(d - c, a))
            continue
        if len(lo1) > OPEN:
            half = len(lo1) // 2
            for part in (slice(half), slice(half, None)):
                stack.append((depth, *(x[part] for x in (lo1, hi1, lo2, hi2, differ))))
            continue
        if depth not in ones:
            bit = (fps >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        count = ones[depth]
        mid1 = hi1 - (count[hi1] - count[lo1])
        mid2 = hi2 - (count[hi2] - count[lo2])
        same = (lo1 == lo2) & (hi1 == hi2)
        parts = [
            (lo1, mid1, lo2, mid2, differ, True),
            (mid1, hi1, mid2, hi2, differ, True),
            (lo1, mid1, mid2, hi2, differ + 1, True),
            (mid1, hi1, lo2, mid2, differ + 1, ~same),
        ]
        nexts = []
        for a, b, c, d, e, wanted in parts:
            keep = (b > a) & (d > c) & (e <= budget) & wanted
            keep &= ~((a == c) & (b == d) & (b - a == 1))
            nexts.append([x[keep] for x in (a, b, c, d, e)])
        merged = [np.concatenate(x) for x in zip(*nexts)]
        if len(merged[0]):
            stack.append((depth + 1, *merged))
    moved = np.flatnonzero(label != np.arange(len(label)))
    return moved, label[moved]


def trie_edges(buckets: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``a, b``: fingerprints linked in a bucket, at most one edge fewer than it has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush(keys, fps):
            if len(keys) > 1:
                i, j = trie_pairs(keys, fps, budget)
                yield pa.RecordBatch.from_arrays([pa.array(fps[i]), pa.array(fps[j])], ["a", "b"])

        for batch in batches:
            keys, fps = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            held.append((keys, fps))
            keys, fps = (np.concatenate(x) for x in zip(*held))
            # the last bucket may go on in the next batch
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            order = np.lexsort((fps[:cut].astype(np.uint64), keys[:cut]))
            yield from flush(keys[:cut][order], fps[:cut][order])
            held = [(keys[cut:], fps[cut:])]
        if held:
            keys, fps = held[0]
            order = np.lexsort((fps.astype(np.uint64), keys))
            yield from flush(keys[order], fps[order])

    dealt_out = buckets.repartition("key").sortWithinPartitions("key")
    return dealt_out.mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, budget: int = BUDGET, limit: int = TRIE) -> DataFrame:
    """Edges that connect all distinct fingerprints (column ``fp``) within ``budget`` bits.

    Buckets fix a quarter of the free bits; one with more than ``limit`` fingerprints is dealt
    out again by the quarters of what is left, until at most 16 bits are free, so no bucket
    exceeds 2**16 rows whatever the data. At each level every close pair meets in some bucket.
    """
    if budget > 3:
        raise ValueError("quarters meet for at most three differing bits")
    rows = distinct.select(F.lit(0).cast("long").alias("key"), "fp")
    edges = None
    for level in range(1, len(WIDTHS) + 1):
        rows = materialise(dealt(rows, level), "buckets")
        large = rows.groupBy("key").count().where(F.col("count") > limit).select("key")
        last = level == len(WIDTHS)
        if not last:
            large = materialise(large, "large-buckets")
            last = large.isEmpty()
        small = rows if last else rows.join(large, "key", "left_anti")
        found = trie_edges(small, budget)
        edges = found if edges is None else edges.unionByName(found)
        if last:
            return edges
        rows = rows.join(large, "key", "left_semi")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """``doc_id, text_key, fp, root, component_id`` of every row.

    Rows are first grouped by fingerprint, so a group of equal texts is one row afterwards.
    Distinct fingerprints are linked by tries, linked ones are joined into components by minima;
    ``component_id`` is the smallest id of a component (null if all its ids are null), ``root``
    its smallest fingerprint. Null and wordless texts have fingerprint 0 and are linked like any
    other. Repeated rows are in one component; no rows give no rows; other columns are left out.
    """
    rows = materialise(fingerprints(docs, shingle), "fingerprints")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    found = components(links(distinct.select("fp"), budget))
    rooted = distinct.join(found, F.col("fp") == F.col("node"), "left")
    rooted = rooted.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialise(rooted.join(least, "root").select("fp", "root", "component_id"), "components")
    return rows.join(named, "fp")


def representatives(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """One row of ``docs`` per component, the one with the smallest id (a null id is largest)."""
    from pyspark.sql import Window

    rows = near_duplicates(docs, shingle, budget)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")
    kept = rows.groupBy("root").agg(F.min(order).alias("k")).select(
        F.col("k.doc_id").alias("_id"), F.col("k.text_key").alias("_key")
    )
    keyed = docs.withColumn("_text_key", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    # rows repeated in full are alike, so any one of them stands for the group
    one = Window.partitionBy("_id", "_key").orderBy("_key")
    numbered = keyed.join(kept, same).withColumn("_n", F.row_number().over(one))
    return numbered.where("_n = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
