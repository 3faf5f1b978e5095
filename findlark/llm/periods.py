"""Periodic runs of words, by internal pattern matching over a suffix order and a wavelet matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.llm.common import batches_of, ship, words

ship(__name__)

MIN_LENGTH = 12
# words of the shortest block; every run of MIN_LENGTH words holds one and its next occurrence
SEED = 4
# bytes of text whose words are put in order together
SCAN_BYTES = 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


class Wavelet:
    """A wavelet matrix over integers below ``2 ** bits``: ranks of zeros, most significant bit first."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, np.int64)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each slice ``[lo, hi)`` are less than ``bound``."""
        found = np.zeros(len(lo), np.int64)
        for bit, zeros, total in self.levels:
            left, right = zeros[lo], zeros[hi]
            one = (bound >> bit & 1).astype(bool)
            found += np.where(one, right - left, 0)
            lo, hi = np.where(one, total + lo - left, left), np.where(one, total + hi - right, right)
        return found

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of rank ``k`` (from 0, below ``hi - lo``) of each slice."""
        value = np.zeros(len(lo), np.int64)
        for bit, zeros, total in self.levels:
            left, right = zeros[lo], zeros[hi]
            one = k >= right - left
            value |= one.astype(np.int64) << bit
            k = np.where(one, k - (right - left), k)
            lo, hi = np.where(one, total + lo - left, left), np.where(one, total + hi - right, right)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray, none: int) -> np.ndarray:
        """The smallest value of each slice that is ``bound`` or more; ``none`` if there is none."""
        rank = self.below(lo, hi, bound)
        there = rank < hi - lo
        value = np.full(len(lo), none, np.int64)
        value[there] = self.smallest(lo[there], hi[there], rank[there])
        return value


class Order:
    """Word ids of several documents, ordered by the suffixes whose first ``SEED`` words come twice.

    Ranks of level ``L`` are equal for two places of one document exactly if the ``L`` words from
    there on are equal. Suffixes whose first words come once cannot take part in a repetition;
    they get ranks of their own.
    """

    def __init__(self, ids: np.ndarray, ends: np.ndarray):
        self.ids, self.ends = ids, ends
        n = len(ids)
        places = self.repeated()
        # lexicographic by document and first words; exact, the hash only left places out
        keys = [ids[places + k] for k in range(SEED - 1, -1, -1)] + [ends[places]]
        places = places[np.lexsort(keys)] if len(places) else places
        same = np.ones(max(0, len(places) - 1), bool)
        for k in range(SEED):
            same &= ids[places[1:] + k] == ids[places[:-1] + k]
        same &= ends[places[1:]] == ends[places[:-1]]
        self.slots = places
        self.ranks: dict[int, np.ndarray] = {}
        size = SEED
        rank = len(places) + np.arange(n, dtype=np.int64)
        first = np.concatenate([[True], ~same]) if len(places) else np.zeros(0, bool)
        while True:
            start = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0)) if len(first) else first.astype(int)
            rank = rank.copy()
            rank[self.slots] = start
            self.ranks[size] = rank
            # slots of groups of two or more
            alone = first & np.concatenate([first[1:], [True]]) if len(first) else first
            open_slots = np.flatnonzero(~alone)
            if not len(open_slots):
                break
            at = self.slots[open_slots]
            # what follows; a block that leaves the document equals nothing
            inside = at + 2 * size <= ends[at]
            follows = np.where(inside, rank[np.where(inside, at + size, 0)], -1 - at)
            order = np.lexsort((follows, start[open_slots]))
            self.slots = self.slots.copy()
            self.slots[open_slots] = at[order]
            sorted_start, sorted_follow = start[open_slots][order], follows[order]
            new = np.ones(len(open_slots), bool)
            new[1:] = (sorted_start[1:] != sorted_start[:-1]) | (sorted_follow[1:] != sorted_follow[:-1])
            first = first.copy()
            first[open_slots] = new
            size *= 2
        self.sizes = sorted(self.ranks, reverse=True)

    def repeated(self) -> np.ndarray:
        """Places whose next ``SEED`` words come twice in their document, and perhaps a few others."""
        count = len(self.ids) - SEED + 1
        if count < 2:
            return np.zeros(0, np.int64)
        total = self.ends[:count].astype(np.uint64) * MIX
        for k in range(SEED):
            total = (total ^ (total >> np.uint64(29))) * MIX + self.ids[k : k + count].astype(np.uint64)
        total ^= total >> np.uint64(32)
        places = np.flatnonzero(np.arange(count) + SEED <= self.ends[:count])
        total = total[places]
        ordered = np.sort(total)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(twice):
            return np.zeros(0, np.int64)
        near = np.minimum(np.searchsorted(twice, total), len(twice) - 1)
        return places[twice[near] == total]

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of places ``a < b`` of one document to the right."""
        done = np.zeros(len(a), np.int64)
        n = len(self.ids)
        for size in self.sizes:
            rank = self.ranks[size]
            i, j = np.minimum(a + done, n - 1), np.minimum(b + done, n - 1)
            equal = (rank[i] == rank[j]) & (b + done < self.ends[b])
            done += np.where(equal, size, 0)
        for _ in range(SEED - 1):
            i, j = np.minimum(a + done, n - 1), np.minimum(b + done, n - 1)
            done += (b + done < self.ends[b]) & (self.ids[i] == self.ids[j])
        return done

    def left(self, a: np.ndarray, b: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of the words before ``a < b`` to the left."""
        done = np.zeros(len(a), np.int64)
        for size in self.sizes:
            rank = self.ranks[size]
            i, j = a - done - size, b - done - size
            inside = i >= starts
            done += np.where(inside & (rank[np.maximum(i, 0)] == rank[np.maximum(j, 0)]), size, 0)
        for _ in range(SEED - 1):
            i, j = a - done - 1, b - done - 1
            done += (i >= starts) & (self.ids[np.maximum(i, 0)] == self.ids[np.maximum(j, 0)])
        return done


def runs(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Rows ``start, end, period`` of all runs of ``least`` words and two periods or more.

    ``ids`` are the words of documents one after another; ``starts`` and ``ends`` hold, for every
    word, where its document begins and ends.

    Blocks of ``L`` words (a power of two) at every half block ask for their occurrences at
    distances from 1.5 L - 1 to 3 L - 2 (from 1 for the shortest): every run of such a period
    holds a block within half a block of its start, and the block again one period later. At
    distances that span no more than ``L`` the occurrences are one arithmetic progression, so three
    range successor queries describe them. Distances inside the block's own run of the
    progression's difference are multiples of it and no smallest periods; the others are
    candidates, and are extended to both sides by ranks.
    """
    empty = np.zeros((0, 3), np.int64)
    if len(ids) < least:
        return empty
    order = Order(ids, ends)
    m = len(order.slots)
    if not m:
        return empty
    # values of the wavelet matrix: the number of a place among the ordered ones
    places = np.sort(order.slots)
    wavelet = Wavelet(np.searchsorted(places, order.slots), int(m + 1).bit_length())
    places = np.append(places, 1 << 60)
    found = [empty]
    for size in sorted(order.ranks):
        rank = order.ranks[size]
        own = np.sort(rank[order.slots])
        block = np.unique(places[:m][places[:m] % (size // 2) == 0])
        lo = rank[block]
        hi = np.searchsorted(own, lo, side="right")
        twice = hi - lo > 1
        block, lo, hi = block[twice], lo[twice], hi[twice]
        if not len(block):
            continue
        near, far = (1, 3 * size - 2) if size == SEED else (3 * size // 2 - 1, 3 * size - 2)
        for low in range(near, far + 1, size + 1):
            high = min(low + size, far)
            found.append(candidates(order, wavelet, places, block, lo, hi, size, low, high, starts, least))
    rows = np.concatenate(found)
    if not len(rows):
        return empty
    # several periods of one stretch are multiples of the smallest
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
    return rows[new]


def candidates(order, wavelet, places, block, lo, hi, size, low, high, starts, least) -> np.ndarray:
    """Runs whose period is a distance from ``low`` to ``high`` between occurrences of blocks."""
    none = len(places) - 1
    first = wavelet.successor(lo, hi, np.searchsorted(places, block + low), none)
    there = places[first] <= block + high
    block, lo, hi, first = block[there], lo[there], hi[there], first[there]
    if not len(block):
        return np.zeros((0, 3), np.int64)
    second = wavelet.successor(lo, hi, first + 1, none)
    more = places[second] <= block + high
    # the last occurrence in the window: as many as lie below the end of the window
    last_rank = wavelet.below(lo, hi, np.searchsorted(places, block + high, side="right")) - 1
    last = wavelet.smallest(lo, hi, last_rank)
    step = np.where(more, places[second] - places[first], 1)
    count = np.where(more, (places[last] - places[first]) // step + 1, 1)
    each = np.repeat(np.arange(len(block)), count)
    nth = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
    a, p = block[each], step[each]
    d = places[first][each] + nth * p - a
    # three or more occurrences: the block has period ``step`` and lies in a run of it
    many = count > 2
    reach = np.zeros(len(block), np.int64)
    reach[many] = step[many] + order.right(block[many], block[many] + step[many])
    inner = many[each] & (d > p) & (d + size <= reach[each])
    a, d = a[~inner], d[~inner]
    begin = a - order.left(a, a + d, starts[a])
    end = a + d + order.right(a, a + d)
    long = end - begin >= np.maximum(least, 2 * d)
    return np.stack([begin[long], end[long], d[long]], 1)


RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType()),
    ]
)


def periodic_runs(docs: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs`` (``doc_id``, ``text``).

    ``runs`` lists ``start, length, period`` (words, from 0) by start, then period, of every stretch
    that repeats with that smallest period, is ``least`` words and two periods long or more, and
    cannot be extended; ``collapsed`` is the text's words, joined by a space, without those that some
    run holds after its first period.

    A null or empty text has no words, no runs and collapses to ''. Rows are judged one by one:
    repeated rows and ids give a row each, a null id stays null, an empty table gives none, other
    columns are ignored. A text is never cut; one task holds its words, about 200 bytes for each.
    Nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches_of(batches, "text", SCAN_BYTES):
            listed = [text.as_buffer().to_pybytes().split() for text in part.column(1)]
            counts = np.array([len(w) for w in listed], np.int64)
            after = np.cumsum(counts)
            flat = pa.array([w for own in listed for w in own], pa.binary())
            ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            found = runs(ids, np.repeat(after - counts, counts), np.repeat(after, counts), least)
            cover = np.zeros(len(ids) + 1, np.int64)
            np.add.at(cover, found[:, 0] + found[:, 2], 1)
            np.add.at(cover, found[:, 1], -1)
            dropped = np.cumsum(cover[:-1]) > 0
            bounds = np.searchsorted(found[:, 0], np.append(after - counts, len(ids) + 1))
            found = found[np.lexsort((found[:, 2], found[:, 0]))]
            texts = []
            for k, own in enumerate(listed):
                if bounds[k + 1] > bounds[k]:
                    gone = dropped[after[k] - counts[k] : after[k]]
                    own = [w for w, g in zip(own, gone) if not g]
                texts.append(b" ".join(own))
            base = np.repeat(after - counts, np.diff(bounds))
            values = [found[:, 0] - base, found[:, 1] - found[:, 0], found[:, 2]]
            lists = pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()),
                pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in values], RUN.names),
            )
            collapsed = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts), lists, collapsed], RESULT.names)

    return rows.mapInArrow(run, RESULT)


def rewritten(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the words of some documents made periodic from a place on.

    With ``h`` the CRC-32 of the decimal id and ``g = h div 10``, texts of ``n > 0`` words with
    ``h mod 10 = 0`` take, for every word ``i >= a``, word ``a + (i - a) mod p``, where ``a = g mod
    n`` and ``p = 1 + (n - a) div (3 + g mod 8)``. Other texts stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def turned(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        at = F.sequence(F.lit(0).cast("long"), n - 1)
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(at, lambda i: F.get(w, place(i).cast("int"))), " ")

    listed = words(F.col("text"))
    new = F.get(
        F.transform(F.array(listed), lambda w: F.when(F.size(w) > 0, turned(w)).otherwise(F.lit(""))), F.lit(0)
    )
    return docs.select(
        F.col("doc_id").cast("long"), F.when(h % 10 == 0, new).otherwise(F.col("text")).alias("text")
    )


def digests(rows: DataFrame) -> DataFrame:
    """The columns of query ``op11_periods`` from those of :func:`periodic_runs`."""
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    return rows.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.n") / (-F.col("best.p"))).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
