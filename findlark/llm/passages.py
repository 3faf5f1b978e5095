"""Near-duplicate passages by compact windows of min-hashes."""

from __future__ import annotations

from array import array
from collections.abc import Generator, Iterable, Iterator
from copy import copy
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from findlark.config import materialise, remove
from findlark.llm.common import release, ship
from findlark.llm.graph import components
from findlark.llm.substrings import groups, mixed, sliding

ship(__name__)

SHINGLE = 5
MIN_WORDS = 50
SIMILARITY = 0.8
# independent hash functions; a pair of passages at the limit misses all with 0.2 ** FUNCTIONS
FUNCTIONS = 3
SCAN_BYTES = 1 << 20
# contents of one value that meet in one task; more are dealt as pairs of blocks
BLOCK = 1024
# contents of a value whose shared shingles are counted as one table
SMALL = 48
# contents that are looked at one by one for what they can add, rather than found by who holds a shingle
FEW = 512
# cells of rows laid out together, of which a dozen tables are held at once, and of pairs compared together
GRID_CELLS = 1 << 19
PAIR_CELLS = 1 << 16
# shingles of contents that are compared together, which are objects then
MEETING = 1 << 19
LAST = (1 << 63) - 1
POSITION_BITS = 22
BASE = np.uint64(0x9DDFEA08EB382D69)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
# the primes of xxHash64, and the bytes that part words
XXH64 = tuple(
    np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)
)
BLANK = np.isin(np.arange(256), [*b" \t\n\r\x0b\x0c"])


def word_hashes(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """xxHash64 of words of ``data``: all words of one length at once, those of 32 bytes or more one by one."""
    import xxhash

    def turned(x: np.ndarray, bits: int) -> np.ndarray:
        return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))

    padded = data + bytes(8)
    lanes = {n: np.ndarray(len(data) + 1, f"<u{n}", padded, strides=(1,)) for n in (1, 4, 8)}
    p1, p2, p3, p4, p5 = XXH64
    hashes = np.zeros(len(starts), np.uint64)
    order = np.argsort(np.minimum(sizes, 32).astype(np.uint8), kind="stable")
    bounds = np.searchsorted(sizes[order], np.arange(1, 33))
    for size, (a, b) in enumerate(zip(bounds, bounds[1:]), 1):
        if a == b:
            continue
        which = order[a:b]
        at = starts[which]
        h = np.full(len(which), p5 + np.uint64(size))
        for k in range(0, size - 7, 8):
            h = turned(h ^ (turned(lanes[8][at + k] * p2, 31) * p1), 27) * p1 + p4
        done = size & ~7
        if size & 4:
            h = turned(h ^ (lanes[4][at + done].astype(np.uint64) * p1), 23) * p2 + p3
            done += 4
        for k in range(done, size):
            h = turned(h ^ (lanes[1][at + k].astype(np.uint64) * p5), 11) * p1
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        hashes[which] = h ^ (h >> np.uint64(32))
    for k in order[bounds[-1] :].tolist():
        hashes[k] = xxhash.xxh64_intdigest(data[starts[k] : starts[k] + sizes[k]])
    return hashes


def shingles(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of texts, one text after another, and shingles per text."""
    data = b" ".join(texts).lower()
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = BLANK[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    owner = np.searchsorted(ends, starts, side="right")
    counts = np.maximum(np.bincount(owner, minlength=len(texts)) - size + 1, 0)
    if not counts.any():
        return np.zeros(0, np.uint64), counts
    each, count = word_hashes(data, starts, sizes), len(starts) - size + 1
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = total * BASE + each[k : k + count]
    return mixed(total[owner[:count] == owner[size - 1 :]]), counts


def compact_windows(hashed: np.ndarray, counts: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, ...]:
    """Compact windows of ``width`` shingles or more: text, left end, place of the minimum, right end.

    In the Cartesian tree over a text's min-hashes, the subtree of a node spans exactly the
    subsequences whose minimum it is. Its node is a compact window if the span has ``width``
    shingles; such nodes are the minima of the runs of ``width``, and the runs with one minimum
    join to its span.
    """
    none = np.zeros(0, np.int64)
    if len(hashed) < width:
        return none, none, none, none
    values = mixed(hashed ^ np.uint64(0xA24BAED4963EE407 * (2 * seed + 1) % (1 << 64))).view(np.int64)
    # the place in the low bits: the leftmost of equal minima is taken, and known at once; more
    # places than the bits hold are scanned in segments that overlap by a window
    low = np.int64((1 << POSITION_BITS) - 1)
    step = max(1, (1 << POSITION_BITS) - width + 1)
    parts = []
    for begin in range(0, len(values) - width + 1, step):
        part = values[begin : begin + step + width - 1]
        parts.append((sliding((part & ~low) | np.arange(len(part)), width, np.minimum) & low) + begin)
    least = np.concatenate(parts)
    owner = np.repeat(np.arange(len(counts)), counts)
    count = len(least)
    inside = owner[:count] == owner[width - 1 :]
    start = inside.copy()
    start[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= start[1:] | ~inside[1:]
    first, last = np.flatnonzero(start), np.flatnonzero(stop)
    return owner[first], first, least[first], last + width - 1


def windows_of(texts: list[bytes], shingle: int, width: int, functions: int) -> tuple[np.ndarray, ...]:
    """All compact windows, cut to ``width`` shingles either side of the minimum: text, value,
    content hash, left end, minimum, right end (places in ``hashes``), and the hashes."""
    hashes, counts = shingles(texts, shingle)
    found = [compact_windows(hashes, counts, width, j) for j in range(functions)]
    owner, left, at, right = (np.concatenate(x) for x in zip(*found))
    seeds = np.repeat(np.arange(functions, dtype=np.uint64), [len(f[0]) for f in found])
    left, right = np.maximum(left, at - width + 1), np.minimum(right, at + width - 1)
    value = mixed(hashes[at] * BASE + seeds).view(np.int64) if len(at) else np.zeros(0, np.int64)
    # hash of the shingles from left to right, whatever stands before them
    powers = np.ones(len(hashes) + 1, np.uint64)
    inverse = np.ones(len(hashes) + 1, np.uint64)
    np.cumprod(np.full(len(hashes), BASE), out=powers[1:])
    np.cumprod(np.full(len(hashes), INVERSE), out=inverse[1:])
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers[:-1], dtype=np.uint64)])
    body = (sums[right + 1] - sums[left]) * inverse[left]
    content = mixed(body * BASE + (at - left).astype(np.uint64) * INVERSE + (right - left).astype(np.uint64))
    return owner, value, content.view(np.int64), left, at, right, hashes, counts


class Contents:
    """Contents laid out by distance from their minimum, which all have in the middle column.

    ``least`` holds the fewest different shingles that a run of ``width`` of a content has, ``places``
    the distance from the minimum of each of ``kinds``, ``plain`` whether a content repeats none.
    ``number`` has the shingles as numbers that each of ``group`` counts for itself, one after another;
    ``kinds`` are such numbers, of contents ``rows``.
    """

    def __init__(self, bodies: list[bytes], at: np.ndarray, width: int, group: np.ndarray | None = None):
        sizes = np.array([len(b) // 4 for b in bodies], np.int64)
        columns, self.width = 2 * width - 1, width
        flat = np.frombuffer(b"".join(bodies), np.uint32)
        self.first = width - 1 - at.astype(np.int64)
        self.last = self.first + sizes - 1
        row = np.repeat(np.arange(len(sizes)), sizes)
        column = np.arange(len(flat)) + np.repeat(self.first - np.cumsum(sizes) + sizes, sizes)
        self.grid = np.zeros((len(sizes), columns), np.int64)
        self.grid[row, column] = flat
        self.group = np.zeros(len(sizes), np.int64) if group is None else group
        kinds, numbers = np.unique((self.group[row] << 32) | flat, return_inverse=True)
        # no shingle at all has the last number
        self.numbers, self.column = len(kinds), np.arange(columns, dtype=np.int32)
        self.number = np.full(self.grid.shape, self.numbers, np.int32)
        self.number[row, column] = numbers
        self.stands = np.full(self.numbers + 1, -1, np.int32)
        # different shingles of each row, and where repeated ones were before
        bits = np.int64(columns.bit_length())
        keys = np.full(self.grid.shape, np.int64(1 << 62))
        keys[row, column] = (flat.astype(np.int64) << bits) | column
        keys.sort(axis=1)
        r, place = np.nonzero(keys < 1 << 62)
        keys = keys[r, place]
        f, c = keys >> bits, keys & ((np.int64(1) << bits) - 1)
        again = np.zeros(len(f), bool)
        again[1:] = (f[1:] == f[:-1]) & (r[1:] == r[:-1])
        self.rows, self.places = r[~again].astype(np.int32), (c[~again] - width + 1).astype(np.int32)
        self.kinds = self.number[self.rows, self.places + width - 1]
        self.starts = np.searchsorted(self.rows, np.arange(len(sizes) + 1))
        self.plain = np.diff(self.starts) == sizes
        # a repeat makes a run poorer if it holds both places
        lowest, highest = np.maximum(c - width + 1, self.first[r])[again], c[np.flatnonzero(again) - 1]
        lies, r = lowest <= highest, r[again]
        poorer = np.bincount((r * (columns + 1) + lowest)[lies], minlength=len(sizes) * (columns + 1))
        poorer -= np.bincount((r * (columns + 1) + highest + 1)[lies], minlength=len(poorer))
        poorer = np.cumsum(poorer.reshape(len(sizes), columns + 1), axis=1)
        run = np.arange(columns + 1)
        poorer[(run < self.first[:, None]) | (run > self.last[:, None] - width + 1)] = 0
        self.least = width - poorer.max(axis=1, initial=0)

    def hopeful(self, sides: np.ndarray, similarity: float) -> np.ndarray:
        """Which contents share enough shingles with the others of their group, taken together, to be
        similar to one of them. ``sides`` is -1, or 0 and 1 in groups where only contents of different
        sides are compared. Those that are left out hold nothing for the rest, so it is done over again."""
        held = self.kinds
        least = self.least * (similarity / (1 + similarity)) - 0.5e-9
        hopeful = np.ones(len(sides), bool)
        row, side = self.rows, sides[self.rows]
        while True:
            # who could be the other one: all others, or those of the other side
            count = np.bincount(held, minlength=self.numbers)
            count = count[held] - np.where(side < 0, 1, 0)
            for one in (0, 1):
                own = side == one
                count[own] -= np.bincount(held[own], minlength=self.numbers)[held[own]]
            shared = np.bincount(row[count > 0], minlength=len(sides))
            lowest = np.full(int(self.group[-1]) + 1, np.inf)
            np.minimum.at(lowest, self.group[hopeful], least[hopeful])
            left = hopeful & (shared >= least + lowest[self.group])
            if left.sum() >= 0.9 * hopeful.sum():
                return left
            hopeful = left
            entries = hopeful[row]
            row, side, held = row[entries], side[entries], held[entries]

    def only(self, which: np.ndarray) -> Contents:
        """The contents at some places."""
        some = copy(self)
        for name in ("first", "last", "number", "least", "plain", "group"):
            setattr(some, name, getattr(self, name)[which])
        some.grid = None
        # a shingle that one content holds decides nothing but sizes
        entries = which[self.rows]
        entries[entries] = (np.bincount(self.kinds[entries], minlength=self.numbers) > 1)[self.kinds[entries]]
        some.rows = (np.cumsum(which, dtype=np.int32) - 1)[self.rows[entries]]
        some.kinds, some.places = self.kinds[entries], self.places[entries]
        some.starts = np.searchsorted(some.rows, np.arange(len(some.first) + 1))
        return some

    def and_(self, others: list[Contents]) -> Contents:
        """These contents and others, the groups of each being others than those before."""
        if not others:
            return self
        every, some = [self, *others], copy(self)
        some.numbers = sum(c.numbers for c in every)
        number = groups = rows = 0
        moved = []
        for c in every:
            # what stands for no shingle is the last number of all
            own = np.where(c.number < c.numbers, c.number + np.int32(number), np.int32(some.numbers))
            moved.append((own, c.kinds + np.int32(number), c.rows + np.int32(rows), c.group + groups))
            number, rows, groups = number + c.numbers, rows + len(c.first), groups + int(c.group[-1]) + 1
        some.number, some.kinds, some.rows, some.group = (np.concatenate(x) for x in zip(*moved))
        for name in ("first", "last", "least", "plain", "places"):
            setattr(some, name, np.concatenate([getattr(c, name) for c in every]))
        some.starts = np.searchsorted(some.rows, np.arange(rows + 1))
        some.stands = np.full(some.numbers + 1, -1, np.int32)
        return some

    def parts(
        self, a: np.ndarray, b: np.ndarray, similarity: float, single: bool = False
    ) -> tuple[np.ndarray, np.ndarray]:
        """The part of pairs of contents, as shingles before and after their shared minimum, in
        which their shingles are similar: their whole common part, or else the best ``width``
        shingles of it; -1 before it if there is none. ``single`` says that the pairs of a group
        have one second content."""
        before, after = np.full(len(a), -1), np.full(len(a), -1)
        plain = self.plain[a] & self.plain[b]
        step = max(1, PAIR_CELLS // self.number.shape[1])
        even, odd = np.flatnonzero(plain), np.flatnonzero(~plain)
        for which in [*([even] if single else self._rounds(b, even)), odd]:
            for k in range(0, len(which), step):
                some = which[k : k + step]
                parts = self._parts if which is odd else self._plain_parts
                before[some], after[some] = parts(a[some], b[some], similarity)
        return before, after

    def _rounds(self, b: np.ndarray, which: np.ndarray) -> list[np.ndarray]:
        """Pairs apart in which one group has several second contents; mostly it has one."""
        rows, inverse = np.unique(b[which], return_inverse=True)
        group = self.group[rows]
        order = np.argsort(group, kind="stable")
        first = np.searchsorted(group[order], group[order])
        turn = np.empty(len(rows), np.int64)
        turn[order] = np.arange(len(rows)) - first
        last = int(turn.max(initial=-1))
        return [which] if last <= 0 else [which[turn[inverse] == k] for k in range(last + 1)]

    def _plain_parts(self, a, b, similarity) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`parts` of contents that repeat no shingle, with one second content in each group:
        a table tells where it has a shingle."""
        width, columns = self.width, self.number.shape[1]
        before, after = np.full(len(a), -1), np.full(len(a), -1)
        low, high = np.maximum(self.first[a], self.first[b]), np.minimum(self.last[a], self.last[b])
        size, column = high - low + 1, self.column
        # the pairs of one second content follow each other
        seconds = np.ones(len(b), bool)
        np.not_equal(b[1:], b[:-1], out=seconds[1:])
        rows = self.number[b[seconds]]
        self.stands[rows] = column
        self.stands[-1] = -1
        place = self.stands[self.number[a]]
        self.stands[rows] = -1
        # both places from low to high, as unsigned distances from it
        low_, beyond = low.astype(np.int32)[:, None], np.maximum(size, 0).astype(np.uint32)[:, None]
        cross = (place - low_).view(np.uint32) < beyond
        cross &= (column - low_).view(np.uint32) < beyond
        both = np.add.reduce(cross, axis=1, dtype=np.intp)
        fits = size >= width
        whole = fits & (both / np.maximum(2 * size - both, 1) >= similarity)
        before[whole], after[whole] = (width - 1 - low)[whole], (high - width + 1)[whole]
        # similar runs share so many different shingles
        needed = similarity / (1 + similarity) * 2 * width - 1e-9
        open_ = np.flatnonzero(fits & ~whole & (both >= needed))
        if len(open_):
            r, c = np.nonzero(cross[open_])
            found, best = self._best(open_, r, c, place[open_[r], c], low, high, similarity)
            before[found], after[found] = width - 1 - best, best
        return before, after

    def _best(self, which, r, i, j, low, high, similarity) -> tuple[np.ndarray, np.ndarray]:
        """Those of some pairs without repeated shingles that have similar runs, and where the best begins.
        ``i`` and ``j`` are the columns of the shingles that both of the pair ``which[r]`` have."""
        width, columns = self.width, self.number.shape[1]
        # a shingle at i and j lies in both runs that begin from max(i, j) - width + 1 to min(i, j)
        lowest = np.maximum(np.maximum(i, j) - width + 1, low[which[r]])
        highest = np.minimum(np.minimum(i, j), high[which[r]] - width + 1)
        lies = lowest <= highest
        shared = np.bincount((r * (columns + 1) + lowest)[lies], minlength=len(which) * (columns + 1))
        shared -= np.bincount((r * (columns + 1) + highest + 1)[lies], minlength=len(shared))
        shared = np.cumsum(shared.reshape(len(which), columns + 1), axis=1)
        run = np.arange(columns + 1)
        shared[(run < low[which, None]) | (run > high[which, None] - width + 1)] = -1
        best = shared.argmax(axis=1)
        most = shared[np.arange(len(which)), best]
        good = most / (2 * width - most) >= similarity
        return which[good], best[good]

    def _parts(self, a, b, similarity) -> tuple[np.ndarray, np.ndarray]:
        width, columns = self.width, self.number.shape[1]
        before, after = np.full(len(a), -1), np.full(len(a), -1)
        low, high = np.maximum(self.first[a], self.first[b]), np.minimum(self.last[a], self.last[b])
        at = np.flatnonzero(high - low + 1 >= width)
        if not len(at):
            return before, after
        x, y, low, high = self.number[a[at]], self.number[b[at]], low[at], high[at]
        column = np.arange(columns)
        outside = (column < low[:, None]) | (column > high[:, None])
        whole = ((x == y) | outside).all(axis=1)
        # the shingles of both, sorted with their side and column; what lies outside is like nothing
        bits = np.int64(columns.bit_length())
        nothing = np.int64(1 << 32) + 2 * column
        keys = np.concatenate([np.where(outside, nothing, x) << 1, (np.where(outside, nothing + 1, y) << 1) | 1], axis=1)
        keys = np.sort((keys << bits) | np.concatenate([column, column]), axis=1)
        shingle, side = keys >> (bits + 1), (keys >> bits) & 1
        same, cross = shingle[:, 1:] == shingle[:, :-1], side[:, 1:] != side[:, :-1]
        cross &= same
        size, both = high - low + 1, cross.sum(axis=1)
        repeated = (same & ~cross).sum(axis=1)
        whole |= both / (2 * size - repeated - both) >= similarity
        before[at[whole]], after[at[whole]] = (width - 1 - low)[whole], (high - width + 1)[whole]
        # similar runs share so many different shingles
        needed = similarity / (1 + similarity) * (self.least[a[at]] + self.least[b[at]]) - 1e-9
        open_ = ~whole & (both >= needed)
        plain = np.flatnonzero(open_ & (repeated == 0))
        if len(plain):
            r, c = np.nonzero(cross[plain])
            mask = (np.int64(1) << bits) - 1
            i, j = keys[plain[r], c] & mask, keys[plain[r], c + 1] & mask
            found, best = self._best(plain, r, i, j, low, high, similarity)
            before[at[found]], after[at[found]] = width - 1 - best, best
        for k in np.flatnonzero(open_ & (repeated > 0)).tolist():
            best = best_run(x[k, low[k] : high[k] + 1].tolist(), y[k, low[k] : high[k] + 1].tolist(), width, similarity)
            if best is not None:
                before[at[k]], after[at[k]] = width - 1 - low[k] - best, low[k] + best
        return before, after


def best_run(x: list[int], y: list[int], width: int, similarity: float) -> int | None:
    """Where the ``width`` places begin at which the different values of ``x`` and ``y`` are most
    similar; ``None`` if they are less than ``similarity``."""
    held: dict[int, list[int]] = {}
    one = other = both = 0
    best, most = None, -1.0
    for k in range(len(x)):
        for side, value in ((0, x[k]), (1, y[k])):
            counts = held.setdefault(value, [0, 0])
            counts[side] += 1
            if counts[side] == 1:
                one, other, both = one + (side == 0), other + (side == 1), both + (counts[1 - side] > 0)
        if k >= width:
            for side, value in ((0, x[k - width]), (1, y[k - width])):
                counts = held[value]
                counts[side] -= 1
                if counts[side] == 0:
                    one, other, both = one - (side == 0), other - (side == 1), both - (counts[1 - side] > 0)
        if k >= width - 1 and both / (one + other - both) > most:
            best, most = k - width + 1, both / (one + other - both)
    return best if most >= similarity else None


def emitted(docs: DataFrame, shingle: int, width: int, functions: int) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, data = batch.column(0), batch.column(1).to_pylist()
            for a, b in groups(data, SCAN_BYTES):
                owner, value, content, left, _, right, _, counts = windows_of(data[a:b], shingle, width, functions)
                base = (np.cumsum(counts) - counts)[owner]
                columns = [
                    pa.array(value), pa.array(content), ids.slice(a, b - a).take(pa.array(owner)),
                    pa.array((left - base).astype(np.int32)), pa.array((right - base).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["value", "content", "doc_id", "left", "right"])

    return texts.mapInArrow(run, "value long, content long, doc_id long, left int, right int")


def matches(
    contents: Contents, begin: int, end: int, blocks: np.ndarray, similarity: float
) -> Generator[tuple[list[int], int], list[tuple[int, int] | None], list[tuple]]:
    """Similar pairs among the contents ``begin`` to ``end``, which are those of one value: their
    places and what :meth:`Contents.parts` finds. It yields what is to be compared next, some contents
    with one later content, and is sent their similar parts, so that many values are compared together.

    A content is compared with those that no pair found before ties it to, in turn, until one is
    similar and ties it to all of that one's; and with those it is tied to as far as that can add to
    spans: where one holds a shingle, in the common part, that no similar part of the other covers
    yet. Those come from lists of who holds a shingle, so a family of near copies costs what its
    differences cost, not its pairs. Pairs are left out where nothing can come of them: two whose
    common part is under ``width``, and two that share too few shingles. If there are two blocks,
    only contents of different blocks are compared.
    """
    width, count = contents.width, end - begin
    flat = contents.kinds[contents.starts[begin] : contents.starts[end]]
    starts = contents.starts[begin : end + 1] - contents.starts[begin]
    kinds, place, holding = np.unique(flat, return_inverse=True, return_counts=True)
    # a shingle that one content holds decides nothing but sizes
    common = (holding > 1)[place]
    least = contents.least[begin:end] * (similarity / (1 + similarity)) - 0.5e-9
    before, after = width - 1 - contents.first[begin:end], contents.last[begin:end] - width + 1
    across, lowest = (blocks != blocks[0]).any(), least.min()

    def possible_with(rows, k, shared: np.ndarray) -> np.ndarray:
        # similar runs share so many different shingles
        possible = shared >= least[rows] + least[k]
        possible &= np.minimum(before[rows], before[k]) + np.minimum(after[rows], after[k]) + 1 >= width
        return possible & (blocks[rows] != blocks[k]) if across else possible

    table = None
    if count <= SMALL:
        # few contents: all counts at once
        which = np.cumsum(holding > 1) - 1
        held_by = np.zeros((count, int(which[-1]) + 1), np.float32)
        held_by[(contents.rows[contents.starts[begin] : contents.starts[end]] - begin)[common], which[place[common]]] = 1
        each = np.arange(count)
        k, j = np.nonzero(np.tril(possible_with(each[:, None], each, np.rint(held_by @ held_by.T)), -1))
        if not len(k):
            return []
        j, ends = j.tolist(), np.searchsorted(k, np.arange(count + 1)).tolist()
        table = [j[a:b] for a, b in zip(ends, ends[1:])]
    chosen = np.concatenate([[0], np.cumsum(common)])[starts].tolist()
    listed, places = flat[common].tolist(), contents.places[contents.starts[begin] : contents.starts[end]][common].tolist()
    # shingles of each content that others hold, with their distance from the minimum
    held_at = [dict(zip(listed[a:b], places[a:b])) for a, b in zip(chosen, chosen[1:])]
    uncovered, plain = [set(own) for own in held_at], contents.plain[begin:end].tolist()
    tie, tied = list(range(count)), [[k] for k in range(count)]
    reach = list(zip(before.tolist(), after.tolist()))
    holders: dict[int, array] = {}
    # who held a shingle uncovered when it came; it may be covered by now
    waiting: dict[int, list[int]] = {}

    found = []

    def within(one: int, some: Iterable[int], b: int, a: int) -> set[int]:
        """Those of some shingles of a content that lie up to ``b`` before its minimum and ``a`` after it."""
        if plain[one]:
            at = held_at[one]
            return {s for s in some if -b <= at[s] <= a}
        return set(contents.number[begin + one, width - 1 - b : width + a].tolist()).intersection(some)

    def adds(j: int, k: int, part: tuple[int, int]) -> bool:
        """Note a similar part; whether it ties the two or covers what was not covered."""
        fresh = False
        for one, other in ((j, k), (k, j)):
            if uncovered[one]:
                inside = within(one, uncovered[one], *part)
                fresh = fresh or not held_at[other].keys().isdisjoint(inside)
                uncovered[one] -= inside
        if tie[j] == tie[k]:
            return fresh
        # the fewer take the name of the more
        old, new = sorted((tie[j], tie[k]), key=lambda t: len(tied[t]))
        for t in tied[old]:
            tie[t] = new
        tied[new] += tied[old]
        tied[old] = []
        return True

    def can_add(j: int, k: int) -> bool:
        if not uncovered[j] and not uncovered[k]:
            return False
        (bj, aj), (bk, ak) = reach[j], reach[k]
        b, a = bj if bj < bk else bk, aj if aj < ak else ak
        # only what both hold in their common part can be added
        for one, other in ((j, k), (k, j)):
            if open_ := held_at[other].keys() & uncovered[one]:
                if plain[one] and plain[other]:
                    x, y = held_at[one], held_at[other]
                    if any(-b <= x[s] <= a and -b <= y[s] <= a for s in open_):
                        return True
                elif within(other, within(one, open_, b, a), b, a):
                    return True
        return False

    for k, own in enumerate(held_at):
        if table is not None:
            possible = table[k]
        else:
            held, needed = [holders[s] for s in own if s in holders], lowest + least[k]
            possible = []
            if len(held) >= needed:
                shared = np.bincount(np.concatenate([np.frombuffer(h, np.int32) for h in held]), minlength=k)
                rows = np.flatnonzero(shared >= needed)
                possible = rows[possible_with(rows, k, shared[rows])].tolist()
        at, step, done = 0, 4, set()
        while at < len(possible):
            # up to the first that is similar; it changes what the others are tied to
            n, some = at, []
            while n < len(possible) and len(some) < step:
                if tie[possible[n]] != tie[k]:
                    some.append(n)
                n += 1
            if not some:
                break
            parts = yield [possible[i] for i in some], k
            hit = next((i for i, part in enumerate(parts) if part), None)
            if hit is None:
                done.update(some)
                at, step = n, min(4 * step, 256)
            else:
                done.update(some[: hit + 1])
                at, step, j = some[hit] + 1, 2, possible[some[hit]]
                adds(j, k, parts[hit])
                found.append((begin + j, begin + k, *parts[hit]))
        if done:
            possible = [j for i, j in enumerate(possible) if i not in done]
        if table is None and len(possible) > FEW:
            near = {j for s in uncovered[k] if s in holders for j in holders[s]}
            for s in own:
                if s in waiting:
                    waiting[s] = [j for j in waiting[s] if s in uncovered[j]]
                    near.update(waiting[s])
            possible = [j for j in possible if j in near]
        rest, step = iter(possible), 16
        # what one covers may leave nothing to the next
        while some := list(islice((j for j in rest if can_add(j, k)), step)):
            for j, part in zip(some, (yield some, k)):
                if part and can_add(j, k) and adds(j, k, part):
                    found.append((begin + j, begin + k, *part))
            step = min(4 * step, 256)
        if table is None:
            for s in own:
                if s in holders:
                    holders[s].append(k)
                else:
                    holders[s] = array("i", (k,))
            for s in uncovered[k]:
                waiting.setdefault(s, []).append(k)
    return found


def compared(batches: Iterator[pa.RecordBatch], width: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Similar pairs of rows sorted by ``value, one, two``, see :func:`verified`."""
    names = ["value", "a", "b", "from_a", "from_b", "size"]
    kept: list[pa.RecordBatch] = []
    waiting: list[tuple[Contents, tuple[np.ndarray, ...]]] = []

    def lay(rows: pa.Table) -> None:
        value, content, at, own = (rows.column(c).to_numpy() for c in ("value", "content", "at", "own"))
        one, two = (rows.column(c).to_numpy() for c in ("one", "two"))
        new = np.any([k[1:] != k[:-1] for k in (value, one, two)], axis=0)
        group = np.concatenate([[0], np.cumsum(new)])
        contents = Contents(rows.column("body").to_pylist(), at, width, group)
        # those that can be similar to none are not looked at any further
        hopeful = contents.hopeful(np.where(one == two, -1, own == two), similarity)
        if hopeful.any():
            waiting.append((contents.only(hopeful), tuple(x[hopeful] for x in (value, content, at, own, one != two))))

    def pairs() -> Iterator[pa.RecordBatch]:
        first, *others = (c for c, _ in waiting)
        contents = first.and_(others)
        value, content, at, own, across = (np.concatenate(x) for x in zip(*(columns for _, columns in waiting)))
        waiting.clear()
        new = np.flatnonzero(np.concatenate([[True], contents.group[1:] != contents.group[:-1], [True]]))
        sizes = np.diff(new)
        # of blocks that meet, both have to be there
        there = ~across[new[:-1]] | (np.maximum.reduceat(own, new[:-1]) != np.minimum.reduceat(own, new[:-1]))
        # most groups are of two: all of those at once
        two = new[:-1][there & (sizes == 2)]
        before, after = contents.parts(two, two + 1, similarity, True)
        found = [np.stack([two, two + 1, before, after], axis=1)[before >= 0]]
        bounds = zip(new[:-1][there & (sizes > 2)].tolist(), new[1:][there & (sizes > 2)].tolist())
        # groups and what they were sent last
        going = [(a, matches(contents, a, b, own[a:b], similarity), None) for a, b in bounds]
        while going:
            asked = []
            for begin, group, answer in going:
                try:
                    asked.append((begin, group, group.send(answer)))
                except StopIteration as over:
                    if over.value:
                        found.append(np.array(over.value))
            a = [begin + j for begin, _, (some, _) in asked for j in some]
            b = [begin + k for begin, _, (some, k) in asked for _ in some]
            before, after = contents.parts(np.array(a, np.int64), np.array(b, np.int64), similarity, True)
            parts = iter([(x, y) if x >= 0 else None for x, y in zip(before.tolist(), after.tolist())])
            going = [(begin, group, [next(parts) for _ in some]) for begin, group, (some, _) in asked]
        j, k, before, after = np.concatenate(found).T
        if len(j):
            columns = [value[j], content[j], content[k]]
            columns += [x.astype(np.int32) for x in (at[j] - before, at[k] - before, before + after + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    for batch in batches:
        kept.append(batch)
        if sum(b.num_rows for b in kept) * 2 * width < GRID_CELLS:
            continue
        rows = pa.Table.from_batches(kept).combine_chunks()
        # the last group may go on in the next batch
        last = [rows.column(c).to_numpy() for c in ("value", "one", "two")]
        differs = np.flatnonzero(np.any([c != c[-1] for c in last], axis=0))
        whole = int(differs[-1]) + 1 if len(differs) else 0
        if whole:
            lay(rows.slice(0, whole))
        kept = rows.slice(whole).to_batches()
        # groups of several layouts are compared together while they have few shingles in common
        if sum(len(c.kinds) for c, _ in waiting) >= MEETING:
            yield from pairs()
    if sum(b.num_rows for b in kept):
        lay(pa.Table.from_batches(kept).combine_chunks())
    if waiting:
        yield from pairs()


def shown_windows(
    rows: pa.RecordBatch, texts: list[bytes], shingle: int, width: int, functions: int
) -> pa.RecordBatch:
    """Shingles of the windows that each of ``rows`` wants, and the place of the minimum in them."""
    owner, value, content, left, at, right, hashes, _ = windows_of(texts, shingle, width, functions)
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    wanted = rows.column(2)
    row = np.repeat(np.arange(len(texts)), pa.compute.list_value_length(wanted).to_numpy(zero_copy_only=False))
    v, c = (x.to_numpy(zero_copy_only=False) for x in wanted.flatten().flatten())
    # wanted ones before the windows they are; of equal windows of a text the first is shown
    value, content, owner = (np.concatenate(x) for x in ((v, value), (c, content), (row, owner)))
    order = np.lexsort((content, value, owner))
    same = np.ones(max(0, len(order) - 1), bool)
    for x in (value, content, owner):
        same &= x[order[1:]] == x[order[:-1]]
    is_window = order >= len(v)
    at_ = np.flatnonzero(same & ~is_window[:-1] & is_window[1:]) + 1
    found = order[at_]
    windows = found - len(v)
    ends = zip(left[windows].tolist(), right[windows].tolist())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(value[found]), pa.array(content[found]), rows.column(0).take(pa.array(owner[found])),
            pa.array([small[a : b + 1].tobytes() for a, b in ends], pa.binary()),
            pa.array((at - left)[windows].astype(np.int32)),
        ],
        ["value", "content", "doc_id", "body", "at"],
    )


def verified(bodies: DataFrame, width: int, similarity: float) -> DataFrame:
    """Similar contents of one value: ``value, a, b`` (content hashes), the first shingle of the
    similar part in each, ``from_a`` and ``from_b``, and its ``size``.

    All contents of a value meet each other, see :func:`matches`. Those of a value with more than
    ``BLOCK`` are dealt into blocks, and each pair of blocks is a group of its own, so that a
    frequent value spreads over tasks.
    """
    hot = bodies.groupBy("value").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    rows = bodies.join(hot.where("blocks > 1"), "value", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    rows = rows.withColumn("own", F.pmod("content", blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    key = ["value", "one", "two"]
    rows = rows.select(
        "value", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "doc_id",
        "content", "body", "at",
    )
    rows = rows.repartition(*key).sortWithinPartitions(*key, "doc_id", "content")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return compared(batches, width, similarity)

    return rows.mapInArrow(compare, "value long, a long, b long, from_a int, from_b int, size int")


def forget(spark: SparkSession, read: list[str]) -> None:
    """Remove tables that no later step reads, and the shuffle files of the steps so far."""
    while read:
        remove(spark, read.pop())
    release(spark)


def near_passages(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
    functions: int = FUNCTIONS,
) -> DataFrame:
    """Which documents share a passage: ``doc_id, class_id, n_links, n_passages, n_words, spans``.

    Two passages of ``min_words`` words or more match if the Jaccard similarity of their
    ``shingle``-word shingles (ASCII lower case) is ``similarity`` or more. For each of
    ``functions`` hash functions a text is cut into compact windows; passages that match share a
    window's minimum with that probability for each function. Values seen once are dropped.
    Windows of equal content are one from then on, represented by the document with the
    smallest id, and tie their documents. All different contents of a value are compared with
    each other, shingle by shingle, over the part that lies in both windows.

    ``class_id`` is the smallest id reachable over matches, the document's own without any;
    ``n_links`` counts the links found that hold the class together; ``spans`` are the word
    ranges (start, end) they rest on, merged, ``n_words`` the words in them. A copy links to
    its representative, not to every other copy. Null texts and texts under ``min_words`` match nothing. Rows that share
    an id are one document; a null id comes last and stays null; no rows give no rows; other
    columns are left out. A task holds one text or about a megabyte.
    """
    spark, width = docs.sparkSession, min_words - shingle + 1
    read: list[str] = []
    rows = emitted(docs, shingle, width, functions).withColumn("doc_id", F.coalesce("doc_id", F.lit(LAST)))
    rows = rows.withColumn("_n", F.count("*").over(Window.partitionBy("value"))).where("_n > 1").drop("_n")
    rows = materialise(rows, "windows")
    release(spark)
    kinds = rows.groupBy("value", "content").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    kinds = materialise(kinds, "contents")
    # documents of equal contents hang on the first of them
    many = kinds.where("n > 1").select("value", "content", "first")
    members = rows.join(many, ["value", "content"])
    star = members.where("doc_id != first").select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    star = materialise(star, "equal-links")
    release(spark)
    several = materialise(kinds.groupBy("value").count().where("count > 1").select("value"), "values", read)
    compared = kinds.join(several, "value", "left_semi")
    wanted = compared.groupBy(F.col("first").alias("_id")).agg(F.collect_list(F.struct("value", "content")).alias("wanted"))

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(1).to_pylist()
            for a, b in groups(data, SCAN_BYTES):
                yield shown_windows(batch.slice(a, b - a), data[a:b], shingle, width, functions)

    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id")
    texts = docs.select(ids, F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"))
    texts = texts.join(wanted, F.col("doc_id") == F.col("_id")).select("_id", "data", "wanted")
    shown = texts.mapInArrow(bodies, "value long, content long, doc_id long, body binary, at int")
    shown = materialise(shown, "window-shingles", read)
    release(spark)
    pairs = materialise(verified(shown, width, similarity), "pairs")
    forget(spark, read)

    # and first ones of similar contents on each other
    names = kinds.select("value", "content", "first")
    tied = pairs.join(names.withColumnsRenamed({"content": "a", "first": "one"}), ["value", "a"])
    tied = tied.join(names.withColumnsRenamed({"content": "b", "first": "two"}), ["value", "b"])
    links = star.unionByName(tied.where("one != two").select(F.col("one").alias("a"), F.col("two").alias("b")))
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = materialise(links, "links")
    roots = components(links)
    both = links.select(F.col("a").alias("doc_id")).unionByName(links.select(F.col("b").alias("doc_id")))
    degree = both.groupBy("doc_id").agg(F.count("*").alias("n_links"))

    # matched word ranges: whole windows of shared contents, the compared part of similar ones
    sides = F.array(*[F.struct(F.col(x).alias("content"), F.col(f"from_{x}").alias("from")) for x in ("a", "b")])
    parts = pairs.select("value", "size", F.explode(sides).alias("s")).select("value", "s.*", "size").distinct()
    whole = members.select("doc_id", F.col("left").alias("start"), (F.col("right") + shingle).alias("end"))
    start = F.col("left") + F.col("from")
    some = rows.join(parts, ["value", "content"]).select(
        "doc_id", start.alias("start"), (start + F.col("size") - 1 + shingle).alias("end")
    )
    own = whole.unionByName(some)
    spans = merged(own)
    result = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id")).distinct()
    result = result.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    result = result.join(degree, "doc_id", "left").join(spans, "doc_id", "left")
    result = result.withColumn("spans", F.when(F.col("n_links") > 0, F.col("spans")))
    ranges = F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))
    return result.select(
        F.nullif("doc_id", F.lit(LAST)).alias("doc_id"),
        F.nullif(F.coalesce("root", "doc_id"), F.lit(LAST)).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.size(ranges).cast("long").alias("n_passages"),
        F.aggregate(ranges, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_words"),
        ranges.alias("spans"),
    )


def merged(rows: DataFrame) -> DataFrame:
    """``doc_id, spans``: the ranges ``start, end`` of each document in order, overlapping ones made one."""
    rows = rows.select("doc_id", "start", "end").repartition("doc_id").sortWithinPartitions("doc_id", "start")

    def joined(rows: pa.Table) -> pa.RecordBatch:
        doc, start, end = (c.to_numpy() for c in rows.columns)
        new_doc = np.concatenate([[True], doc[1:] != doc[:-1]])
        # the last end so far in each document
        until = np.maximum.accumulate((np.cumsum(new_doc) << 32) + end) & ((1 << 32) - 1)
        new = new_doc.copy()
        new[1:] |= start[1:] > until[:-1]
        first = np.flatnonzero(new)
        ends = until[np.append(first[1:], len(doc)) - 1].astype(np.int32)
        ranges = pa.StructArray.from_arrays([pa.array(start[first]), pa.array(ends)], ["start", "end"])
        bounds = np.append(np.flatnonzero(new_doc[first]), len(first)).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(doc[new_doc]), pa.ListArray.from_arrays(pa.array(bounds), ranges)], ["doc_id", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            doc = batch.column(0).to_numpy()
            # the last document may go on in the next batch
            last = int(np.searchsorted(doc, doc[-1])) if len(doc) else 0
            if last:
                yield joined(pa.Table.from_batches([*kept, batch.slice(0, last)]).combine_chunks())
                kept = []
            elif kept and len(doc) and kept[-1].column(0)[0].as_py() != doc[0]:
                yield joined(pa.Table.from_batches(kept).combine_chunks())
                kept = []
            if len(doc):
                kept.append(batch.slice(last))
        if kept:
            yield joined(pa.Table.from_batches(kept).combine_chunks())

    return rows.mapInArrow(run, "doc_id long, spans array<struct<start:int,end:int>>")
