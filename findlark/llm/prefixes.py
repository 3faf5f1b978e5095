"""Prefix trie of conversations, rolled up by centroid decomposition of its parent edges."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.config import materialise
from findlark.llm.common import ship

ship(__name__)

# Prefixes are told apart by four polynomials over their turns modulo a prime, 124 bits together.
PRIME = (1 << 31) - 1
BASES = (1103515245 % PRIME, 1664525, 22695477, 69069)
# nodes of a component that one task takes apart; larger ones are split by joins before
GATHER = 1 << 16
# bytes of joined ids that one row carries to where a node's ids are hashed
CHUNK = 1 << 16
MAX_HEAD = 5
HEAD = 32


def signatures(conversations: DataFrame) -> DataFrame:
    """Turns without their texts: ``conv_id, turn, role, head, x0..x3, chars``.

    Four hashes below :data:`PRIME` stand for role and text, ``head`` (the text's first characters)
    orders turns of equal number, ``chars`` counts code points. Rows without ``conv_id`` are left
    out; a null role or text is empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    a, b = F.xxhash64(role, text), F.xxhash64(text, role, F.lit(1))
    low = lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF)) % PRIME
    parts = [low(a), low(F.shiftrightunsigned(a, 32)), low(b), low(F.shiftrightunsigned(b, 32))]
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        role.alias("role"),
        F.substring(text, 1, HEAD).alias("head"),
        *[part.cast("long").alias(f"x{k}") for k, part in enumerate(parts)],
        F.length(text).cast("long").alias("chars"),
    )


def by_turn() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), *[F.col(c) for c in ("role", "head", "x0", "x1", "x2", "x3")]]


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base`` to each exponent modulo :data:`PRIME`."""
    out = np.ones(len(exponents), np.uint64)
    square, left = base, int(exponents.max(initial=0))
    bit = 0
    while left >> bit:
        odd = (exponents >> bit & 1).astype(bool)
        out[odd] = out[odd] * np.uint64(square) % np.uint64(PRIME)
        square = square * square % PRIME
        bit += 1
    return out


def numbered(turns: DataFrame, order: Sequence[Column], lanes: bool, tag: str) -> DataFrame:
    """``turns`` numbered from 1 in each ``conv_id`` (``depth``), with ``last`` for its last row.

    With ``lanes``, ``f0..f3`` fingerprint the turns up to the row and ``p0..p3`` those before it.

    Rows are range-sorted by conversation and ``order``, so one conversation may reach over many
    tasks. Each task numbers its own part and adds one row that sums up its last conversation; the
    sums are composed over the tasks (one row for each) and applied to the first conversation of
    each part.
    """
    keys = [F.col("conv_id"), *order]
    rows = turns.repartitionByRange(*keys).sortWithinPartitions(*keys)
    names = ["depth"] + ([f"f{k}" for k in range(4)] + [f"p{k}" for k in range(4)] if lanes else [])
    flags = [("_part", T.IntegerType()), ("_kind", T.IntegerType()), ("_head", T.LongType()), ("last", T.BooleanType())]
    added = [T.StructField(n, T.LongType()) for n in names] + [T.StructField(n, t) for n, t in flags]
    schema = T.StructType([*turns.schema.fields, *added])
    bases = BASES if lanes else ()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        arrow = None
        head = conv = None
        done, state = 0, [0] * len(bases)
        held = None

        def out(batch, columns, kind, last):
            n = batch.num_rows
            more = [pa.array(c, pa.int64()) for c in columns]
            more += [pa.array(np.full(n, part, np.int32)), pa.array(kind, pa.int32())]
            more += [pa.array(np.full(n, head, np.int64)), pa.array(last, pa.bool_())]
            return pa.RecordBatch.from_arrays([*batch.columns, *more], schema.names)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            arrow = batch.schema
            ids = batch.column(arrow.get_field_index("conv_id")).to_numpy(zero_copy_only=False)
            head = int(ids[0]) if head is None else head
            new = np.ones(n, bool)
            new[1:] = ids[1:] != ids[:-1]
            new[0] = conv != int(ids[0])
            if held is not None:
                yield out(held[0], held[1], held[2], [bool(new[0])])
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            at = np.arange(n) - np.maximum(start, 0) + np.where(start < 0, done, 0)
            columns = [at + 1]
            before = []
            for k, base in enumerate(bases):
                x = batch.column(arrow.get_field_index(f"x{k}")).to_numpy(zero_copy_only=False).astype(np.uint64)
                term = (x + np.uint64(1)) * powers(base, at) % np.uint64(PRIME)
                total = np.concatenate([[0], np.cumsum(term.astype(np.int64))])
                own = total[:-1] - total[np.maximum(start, 0)] + np.where(start < 0, state[k], 0)
                before.append(own % PRIME)
                columns.append((own + term.astype(np.int64)) % PRIME)
                state[k] = int(columns[-1][-1])
            columns += before
            conv, done = int(ids[-1]), int(at[-1]) + 1
            # 1: of the conversation this part begins with, 0: of another
            kind = (ids == head).astype(np.int32)
            if n > 1:
                yield out(batch.slice(0, n - 1), [c[:-1] for c in columns], kind[:-1], new[1:])
            held = (batch.slice(n - 1), [c[-1:] for c in columns], kind[-1:])
        if held is not None:
            yield out(held[0], held[1], held[2], [True])
            # 2: a summary of the part's last conversation
            yield out(held[0], held[1], [2], [True])

    local = materialise(rows.mapInArrow(number, schema), tag)
    carried = materialise(carries(local.where("_kind = 2"), len(bases)), "carries")
    # one row per partition of the sort
    rows = local.where("_kind < 2").join(F.broadcast(carried), "_part")
    first = F.col("_kind") == 1
    out = []
    for name in turns.columns:
        out.append(F.col(name))
    out.append((F.col("depth") + F.when(first, F.col("_n")).otherwise(0)).alias("depth"))
    for k in range(len(bases)):
        for name in (f"f{k}", f"p{k}"):
            moved = (F.col(f"_f{k}") + F.col(f"_c{k}") * F.col(name)) % PRIME
            out.append(F.when(first, moved).otherwise(F.col(name)).alias(name))
    # the last row of a part ends its conversation unless the next part goes on with it
    ends = F.col("last") & ~((F.col("conv_id") == F.col("_tail")) & F.col("_goes_on"))
    return rows.select(*out, ends.alias("last"))


def carries(summaries: DataFrame, lanes: int) -> DataFrame:
    """What the conversation at the start of each part brings along, from one summary per part."""
    names = ["_part", "_n", "_tail", *[f"_{x}{k}" for k in range(lanes) for x in "fc"]]
    schema = T.StructType([T.StructField(n, T.IntegerType() if n == "_part" else T.LongType()) for n in names])
    schema = schema.add("_goes_on", T.BooleanType())
    rows = summaries.select(
        "_part", "_head", "conv_id", "depth", *[f"f{k}" for k in range(lanes)]
    )

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = sorted(tuple(r.values()) for b in batches for r in b.to_pylist())
        out, conv, n, sums = [], None, 0, [0] * lanes
        for k, (part, head, tail, count, *own) in enumerate(parts):
            if head != conv:
                n, sums = 0, [0] * lanes
            scale = [pow(base, n, PRIME) for base in BASES[:lanes]]
            goes_on = k + 1 < len(parts) and parts[k + 1][1] == tail
            out.append([part, n, tail, *[v for pair in zip(sums, scale) for v in pair], goes_on])
            if head == tail:
                n, sums = n + count, [(s + c * f) % PRIME for s, c, f in zip(sums, scale, own)]
            else:
                n, sums = count, own
            conv = tail
        columns = list(zip(*out)) if out else [[] for _ in schema.names]
        types = [pa.int32(), *[pa.int64()] * (len(columns) - 2), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema.names)

    return rows.coalesce(1).mapInArrow(compose, schema)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the one of their hundred: ids, and turns with ``turn`` renumbered.

    ``turns`` are numbered (:func:`numbered`). With ``h`` the CRC-32 of the decimal id modulo 6,
    conversation ``c`` takes the first ``h`` turns of ``c - c mod 100``, then its own after ``h``.
    """
    c = F.col("conv_id")
    h = F.crc32(c.cast("string").cast("binary")) % 6
    content = ["role", "head", "x0", "x1", "x2", "x3", "chars"]
    ids = turns.where("depth = 1").select("conv_id")
    own = turns.where(F.col("depth") > h).select("conv_id", F.lit(1).alias("_own"), F.col("depth").alias("turn"), *content)
    # at most MAX_HEAD turns of one conversation in a hundred, for at most a hundred others
    first = turns.where((F.col("depth") <= MAX_HEAD) & (c % 100 == 0)).select(
        c.alias("_base"), F.lit(0).alias("_own"), F.col("depth").alias("turn"), *content
    )
    heads = ids.select("conv_id", (c - c % 100).alias("_base"), h.alias("_h")).join(first, "_base").where("turn <= _h")
    return ids, own.unionByName(heads.select(own.columns))


NODE = ["depth", "k0", "k1"]
MEMBERS = T.StructType(
    [T.StructField("depth", T.LongType()), T.StructField("k0", T.LongType()), T.StructField("k1", T.LongType())]
)


def key(prefix: str) -> list[Column]:
    """Two longs of a fingerprint's four parts of 31 bits."""
    pair = lambda a, b: F.col(f"{prefix}{a}") * (1 << 31) + F.col(f"{prefix}{b}")
    return [pair(0, 1), pair(2, 3)]


def end_digests(ends: DataFrame) -> DataFrame:
    """``depth, k0, k1, ends_sha256`` of nodes from the ids that end there (``conv_id``).

    SHA-256 reads its input in order, so one task hashes the ids of a node. It only sees them
    as joined pieces of :data:`CHUNK` bytes, one at a time: a range sort makes the pieces on all
    tasks before.
    """
    chunk = T.StructType([*MEMBERS.fields, T.StructField("first", T.LongType()), T.StructField("ids", T.StringType())])
    digest = T.StructType([*MEMBERS.fields, T.StructField("ends_sha256", T.StringType())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            new = np.ones(batch.num_rows, bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)
            cuts = np.flatnonzero(new).tolist() + [batch.num_rows]
            texts = batch.column(3).cast(pa.string()).to_pylist()
            starts, joined = [], []
            for lo, hi in zip(cuts, cuts[1:]):
                for at in range(lo, hi, CHUNK // 20):
                    starts.append(at)
                    joined.append(",".join(texts[at : min(hi, at + CHUNK // 20)]))
            picked = batch.take(pa.array(starts))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(joined, pa.string())], chunk.names)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for *own, ids in zip(*[batch.column(k).to_pylist() for k in (0, 1, 2, 4)]):
                if own == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    out.append([*node, state.hexdigest()])
                node, state = own, hashlib.sha256(ids.encode())
            yield result(out)
        if node is not None:
            yield result([[*node, state.hexdigest()]])

    def result(rows):
        columns = list(zip(*rows)) if rows else [[]] * 4
        types = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], digest.names)

    rows = ends.select(*NODE, "conv_id")
    rows = rows.repartitionByRange(*rows.columns).sortWithinPartitions(*rows.columns).mapInArrow(pieces, chunk)
    rows = rows.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return rows.mapInArrow(hashed, digest)


def decompose(parent: np.ndarray, depth: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (one row per node) over the subtrees of a forest, by centroid decomposition.

    ``parent`` holds places of parents, -1 for tops; ``depth`` grows from parent to child. In every
    round each component gives up its centroid: of the nodes with more than half of the component
    below them, which form a path from the top, the lowest. The total below the centroid is added to
    all nodes of that path, the parts below become components of their own, and so does the rest
    above. No component has more than half the nodes of the one it came from.
    """
    n = len(parent)
    above, sums, size = parent.copy(), np.zeros_like(values), np.ones(n, np.int64)
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[parent[level] >= 0]
        np.add.at(size, parent[level], size[level])
    active = np.arange(n)
    top = tops(above, active)
    while len(active):
        on_path = 2 * size[active] > size[top[active]]
        path = active[on_path]
        its = top[path]
        # the lowest of a path is its smallest
        by = np.lexsort((size[path], its))
        lead = np.ones(len(by), bool)
        lead[1:] = its[by][1:] != its[by][:-1]
        centroid = np.zeros(n, np.int64)
        centroid[its[by][lead]] = path[by][lead]
        gone = np.zeros(n, bool)
        gone[path[by][lead]] = True
        active = active[~gone[active]]
        below = active[(above[active] >= 0) & gone[above[active]]]
        over = above[below]
        above[below] = -1
        top = tops(above, active)
        totals = np.zeros_like(values)
        np.add.at(totals, top[active], values[active])
        lower = values.copy()
        np.add.at(lower, over, totals[below])
        sums[path] += lower[centroid[its]]
        stays = ~gone[path]
        size[path[stays]] -= size[centroid[its[stays]]]
    return sums


def tops(above: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The top of each node, by doubling the steps up; of other places only the place itself."""
    top = np.arange(len(above))
    top[nodes] = np.where(above[nodes] >= 0, above[nodes], nodes)
    while True:
        further = top[top[nodes]]
        if np.array_equal(further, top[nodes]):
            return top
        top[nodes] = further


def rolled_up(nodes: DataFrame, values: Sequence[str]) -> DataFrame:
    """``nodes`` of whole components (``_comp`` columns) with ``<value>`` summed over their subtrees.

    Each task gets whole components of at most :data:`GATHER` nodes and takes several together.
    """
    schema = T.StructType([*nodes.schema.fields, *[T.StructField(f"sub_{v}", T.LongType()) for v in values]])
    place = {name: k for k, name in enumerate(nodes.columns)}

    def finish(parts: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(parts).combine_chunks()
        column = lambda name: table.column(place[name]).to_numpy(zero_copy_only=False)
        owner, depth = column("conv_id"), column("depth")
        over = table.column(place["_over"]).fill_null(0).to_numpy()
        names, code = np.unique(np.concatenate([owner, over]), return_inverse=True)
        width = int(depth.max()) + 2
        mine, theirs = code[: len(owner)] * width + depth, code[len(owner) :] * width + depth - 1
        order = np.argsort(mine)
        found = np.minimum(np.searchsorted(mine[order], theirs), len(mine) - 1)
        parent = order[found]
        parent = np.where((mine[parent] == theirs) & (depth > 0) & ~column("_top").astype(bool), parent, -1)
        sums = decompose(parent, depth, np.stack([column(v) for v in values], 1))
        added = [pa.array(sums[:, k] + column(f"_sum_{v}")) for k, v in enumerate(values)]
        return pa.Table.from_arrays([*table.columns, *added], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if count >= GATHER:
                # up to the last change of component; the rest waits for what follows
                table = pa.Table.from_batches([*parts, batch]).combine_chunks()
                comps = [table.column(place[c]).to_numpy(zero_copy_only=False) for c in ("_comp_id", "_comp_depth")]
                change = np.flatnonzero((comps[0][1:] != comps[0][:-1]) | (comps[1][1:] != comps[1][:-1]))
                if len(change):
                    stop = int(change[-1]) + 1
                    yield from finish(table.slice(0, stop).to_batches()).to_batches()
                    parts, count = table.slice(stop).to_batches(), table.num_rows - stop
                    continue
            parts.append(batch)
            count += batch.num_rows
        if parts:
            yield from finish(parts).to_batches()

    rows = nodes.repartition("_comp_id", "_comp_depth").sortWithinPartitions("_comp_id", "_comp_depth")
    return rows.mapInArrow(run, schema)


def split(nodes: DataFrame, rows: DataFrame, values: Sequence[str]) -> DataFrame:
    """``nodes`` in components of at most :data:`GATHER` nodes, centroids of larger ones taken out.

    A node weighs as many turns as pass through it, so the weight of a subtree is a grouped sum over
    the turns of its members and needs no walk. Each round takes the centroids of all components
    that are too large, adds the totals below them to the nodes on the paths above, and relabels the
    parts below: a node lies below a centroid if the conversation that owns it passes through one
    of the centroid's children.
    """
    comp = ["_comp_id", "_comp_depth"]
    was = [f"_was{c}" for c in comp]
    named = [F.col(c).alias(w) for c, w in zip(comp, was)]
    ready = []
    while True:
        sizes = nodes.groupBy(*comp).agg(F.count("*").alias("_nodes"), F.max("_size").alias("_total"))
        large = sizes.where(F.col("_nodes") > GATHER).select(*comp, "_total")
        large = materialise(large, "large")
        ready.append(nodes.join(large, comp, "left_anti"))
        if large.isEmpty():
            break
        inner = nodes.join(large, comp)
        path = inner.where(F.col("_size") * 2 > F.col("_total"))
        cut = path.groupBy(*comp, "_total").agg(
            F.min_by(F.struct("conv_id", "depth", "_size", *values), F.col("_size")).alias("_cut")
        )
        cut = cut.select(
            *named,
            "_total",
            F.col("_cut.conv_id").alias("_z"),
            F.col("_cut.depth").alias("_z_depth"),
            F.col("_cut._size").alias("_z_size"),
            *[F.col(f"_cut.{v}").alias(f"_own_{v}") for v in values],
        )
        cut = materialise(cut, "cuts")
        # the centroids' children, the conversations through them, the nodes those own
        child = inner.where("not _top").select(*NODE, F.col("conv_id").alias("_to"), "_over", *named)
        child = child.withColumn("_z_depth", F.col("depth") - 1)
        child = child.join(cut.select(*was, F.col("_z").alias("_over"), "_z_depth"), [*was, "_over", "_z_depth"])
        through = rows.join(child.select(*NODE, "_to", *was), NODE)
        through = through.select("conv_id", "_to", F.col("depth").alias("_to_depth"), *was)
        inside = F.coalesce(F.col("depth") >= F.col("_to_depth"), F.lit(False))
        moved = inner.drop("_total").select("*", *named).join(through, [*was, "conv_id"], "left")
        moved = moved.withColumn("_below", inside)
        moved = moved.withColumn("_top", F.col("_top") | (F.col("_below") & (F.col("depth") == F.col("_to_depth"))))
        moved = moved.withColumn("_comp_id", F.when(F.col("_below"), F.col("_to")).otherwise(F.col("_comp_id")))
        moved = moved.withColumn(
            "_comp_depth", F.when(F.col("_below"), F.col("_to_depth")).otherwise(F.col("_comp_depth"))
        )
        moved = materialise(moved.select(*nodes.columns, *was, "_below"), "moved")
        totals = moved.where("_below").groupBy(*was).agg(*[F.sum(v).alias(f"_low_{v}") for v in values])
        met = moved.join(cut.join(totals, was, "left"), was)
        on_path = ~F.col("_below") & (F.col("_size") * 2 > F.col("_total"))
        is_cut = on_path & (F.col("conv_id") == F.col("_z")) & (F.col("depth") == F.col("_z_depth"))
        for v in values:
            low = F.col(f"_own_{v}") + F.coalesce(F.col(f"_low_{v}"), F.lit(0))
            met = met.withColumn(f"_sum_{v}", F.col(f"_sum_{v}") + F.when(on_path, low).otherwise(0))
        met = met.withColumn("_is_cut", is_cut)
        met = met.withColumn("_size", F.col("_size") - F.when(on_path & ~is_cut, F.col("_z_size")).otherwise(0))
        met = materialise(met.select(*nodes.columns, "_is_cut"), "split")
        # a centroid is a component of its own from here on; its sum is whole
        alone = met.where("_is_cut").withColumn("_top", F.lit(True))
        alone = alone.withColumn("_comp_id", F.col("conv_id")).withColumn("_comp_depth", F.col("depth"))
        for v in values:
            alone = alone.withColumn(f"_sum_{v}", F.col(f"_sum_{v}") - F.col(v))
        ready.append(alone.select(nodes.columns))
        nodes = met.where("not _is_cut").select(nodes.columns)
    return reduce(DataFrame.unionByName, ready)


def prefix_trie(turns: DataFrame, order: Sequence[Column] | None = None, ids: DataFrame | None = None) -> DataFrame:
    """One row per distinct sequence of first turns, the empty one included.

    ``turns`` are those of :func:`signatures` (a conversation's turns go by number, null first, then
    role and text) or others with ``conv_id, x0..x3, chars`` and an ``order`` of their own; ``ids``
    adds conversations without turns. Columns: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs`` (members), ``n_children``, ``n_leaves``
    (childless nodes of the subtree), ``saved_tokens`` (over the subtree, members but one times code
    points of the node's last text), ``ends_sha256`` (SHA-256 of the ids that end at the node,
    ascending, comma-joined).

    Rows without ``conv_id`` are left out; null roles and texts are empty; turns repeated in full
    count each time. Without any conversation there is no row, not even a root. Other columns are
    ignored. A conversation, a node's members or a subtree may hold any share of the rows.
    """
    rows = numbered(turns, by_turn() if order is None else order, True, "turns")
    at, before = key("f"), key("p")
    rows = rows.select(
        "conv_id", "depth", at[0].alias("k0"), at[1].alias("k1"), before[0].alias("_p0"), before[1].alias("_p1"),
        "chars", "last",
    )
    everyone = rows.where("last").select("conv_id")
    empty = None
    if ids is not None:
        everyone = ids.select(F.col("conv_id").cast("long")).where("conv_id is not null").distinct()
        empty = everyone.join(rows.where("last").select("conv_id"), "conv_id", "left_anti")
    grouped = rows.groupBy(*NODE, "_p0", "_p1").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars")
    )
    root = everyone.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    zero = [F.lit(0).cast("long").alias(c) for c in (*NODE, "_p0", "_p1")]
    root = root.select(*zero, "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"))
    nodes = materialise(grouped.unionByName(root), "nodes")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k0").alias("_p0"), F.col("k1").alias("_p1"), F.col("conv_id").alias("_over")
    )
    # the root has the most children, and one name
    smallest = nodes.where("depth = 0").agg(F.min("conv_id").alias("conv_id")).scalar()
    first = nodes.where("depth = 1").withColumn("_over", smallest)
    deeper = nodes.where("depth > 1").join(parents.where("depth > 1"), ["depth", "_p0", "_p1"])
    top = nodes.where("depth = 0").withColumn("_over", F.lit(None).cast("long"))
    linked = materialise(top.unionByName(first).unionByName(deeper.select(top.columns)), "linked")
    kids = linked.where("depth > 0").groupBy(F.col("_over").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    kids = kids.agg(F.count("*").alias("n_children"))
    values = ["leaves", "saved"]
    full = linked.join(kids, ["conv_id", "depth"], "left").select(
        "conv_id", *NODE, "_over", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        *[F.lit(0).cast("long").alias(f"_sum_{v}") for v in values],
        (F.col("depth") == 0).alias("_top"),
    )
    full = full.withColumns({"_comp_id": smallest, "_comp_depth": F.lit(0).cast("long")})
    full = materialise(full, "trie")
    parts = full
    if full.count() > GATHER:
        weighed = full.join(weights(rows), NODE, "left")
        # the root is passed by all turns and by each conversation once
        all_turns = rows.where("last").agg(F.sum("depth").alias("n")).scalar()
        weighed = weighed.withColumn("_size", F.coalesce("_size", all_turns + F.col("n_convs")))
        parts = split(weighed, rows, values).drop("_size")
    summed = rolled_up(parts, values)
    ends = rows.where("last").select("conv_id", *NODE)
    if empty is not None:
        ends = ends.unionByName(empty.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in NODE]))
    out = summed.join(end_digests(ends), NODE, "left")
    return out.select(
        "conv_id",
        "depth",
        F.col("_over").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("sub_leaves").alias("n_leaves"),
        F.col("sub_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def weights(rows: DataFrame) -> DataFrame:
    """``depth, k0, k1, _size``: turns of a node's members from the node on.

    The length of a conversation meets its turns in blocks of depths, so a very long one is dealt to
    many tasks.
    """
    block = 1 << 12
    lengths = rows.where("last").select(
        "conv_id", F.col("depth").alias("_len"), F.explode(F.sequence(F.lit(0), F.floor(F.col("depth") / block).cast("int"))).alias("_block")
    )
    met = rows.withColumn("_block", F.floor(F.col("depth") / block).cast("int")).join(lengths, ["conv_id", "_block"])
    return met.groupBy(*NODE).agg(F.sum(F.col("_len") - F.col("depth") + 1).alias("_size"))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations after :func:`rebuilt`."""
    turns = numbered(signatures(conversations), by_turn(), False, "order")
    ids, new = rebuilt(turns)
    return prefix_trie(new, [F.col("_own"), F.col("turn")], ids)


# The CRC-32 comes from its polynomial; a node is told by the list of its turns, its subtree by the
# nodes whose smallest member passes through it.
SQL = """
WITH bits AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), conv AS (
  SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(range(1, length(c::VARCHAR) + 1), lambda k: ascii(substr(c::VARCHAR, k::INT, 1))::BIGINT)),
    lambda a, b: xor(a >> 8, t[((xor(a, b) & 255) + 1)::INT])), 4294967295::BIGINT) % 6 AS h
  FROM conv, bits
), num AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), new AS (
  SELECT crc.c, 0 AS o, i, r, t FROM crc JOIN num ON num.c = crc.c - crc.c % 100 AND i <= h
  UNION ALL SELECT crc.c, 1, i, r, t FROM crc JOIN num ON num.c = crc.c AND i > h
), member AS (
  SELECT c, row_number() OVER w AS d, t, list([r, t]) OVER (w ROWS UNBOUNDED PRECEDING) AS p
  FROM new WINDOW w AS (PARTITION BY c ORDER BY o, i)
  UNION ALL SELECT c, 0, '', [] FROM crc
), node AS (
  SELECT p, d, min(c) AS c, count(*) AS n, max(length(t)) AS chars FROM member GROUP BY p, d
), path AS (
  SELECT member.c, d, node.c AS top FROM member JOIN node USING (p, d)
), par AS (
  SELECT node.c, node.d, path.top AS parent FROM node LEFT JOIN path ON path.c = node.c AND path.d = node.d - 1
), kids AS (
  SELECT parent AS c, d - 1 AS d, count(*) AS k FROM par WHERE d > 0 GROUP BY 1, 2
), val AS (
  SELECT node.c, node.d, n, coalesce(k, 0) AS k, k IS NULL AS leaf, (n - 1) * chars AS spared
  FROM node LEFT JOIN kids USING (c, d)
), sub AS (
  SELECT path.top AS c, path.d, count(*) FILTER (leaf) AS leaves, sum(spared) AS saved
  FROM val JOIN path ON path.c = val.c AND path.d <= val.d GROUP BY 1, 2
), ends AS (
  SELECT top AS c, d, string_agg(path.c::VARCHAR, ',' ORDER BY path.c) AS ids
  FROM path JOIN (SELECT c, max(d) AS d FROM member GROUP BY c) AS last USING (c, d) GROUP BY 1, 2
)
SELECT val.c AS conv_id, val.d AS depth, parent AS parent_conv_id, n AS n_convs, k AS n_children,
  leaves AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM val JOIN par USING (c, d) JOIN sub USING (c, d) LEFT JOIN ends USING (c, d)
"""
