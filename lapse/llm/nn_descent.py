"""Approximate nearest neighbours by inner product: NN-descent graph, greedy graph search.

1. Rows with the same vector become one node (numbered by smallest id, then vector); each node keeps the ``TOP`` + 1
   smallest ids of its rows, which is all that a list of ``TOP`` neighbours with ties to smaller ids can show.
2. A vector gets one more component, sqrt(longest**2 - its length**2), so that a large inner product means
   near, and is kept as bytes (a signed byte per component and a scale) while the graph is built.
3. The first neighbours come from leaves of random hyperplane trees (a leaf over ``LEAF`` rows is split by
   a hash) and from groups of about ``CHANCE`` nodes by a hash, so a node alone in its leaves has some, too.  Then rounds of NN-descent: every node hands itself to its sampled neighbours (reverse edges), a
   co-grouping by node joins them with its own neighbours, every pair of a node's members that holds a new
   one is compared, members that handed themselves over are offered what beats their worst neighbour, and each node keeps its ``DEGREE`` best.  Members per node and round are bounded, so a
   node that many list does not grow a task; rounds go on until few edges change.
4. Queries walk the graph together: a round joins the best nodes of every query's list not yet expanded with
   the graph (and some edges back), scores their neighbours, and keeps the ``BEAM`` best; it ends when no list has one left.
   A list begins with the node's neighbours and the best of sqrt(nodes) entry points.  Components of the graph
   are linked through a graph of their heads (``bridges``).
   Bytes give every score an error, and the list carries its size: all entries that may belong to the ``TOP`` best
   within six standard errors are scored in double precision on the original vectors.  A query whose full list ends
   inside that band, that has more than ``WIDE`` entries in it (both say: a group of near copies that bytes cannot
   tell apart), or that has fewer rows than it could have, is compared with all nodes, block by block: the exact way
   past the list's width.

Results for odd input: vectors that are null, empty, zero, of another length than most, or that hold null or
non-finite components take no part; null ids take no part; a repeated row counts once per row, an id that
occurs twice with different vectors is two rows, each a query with a list of its own and a candidate of the other; an empty table gives an empty result; extra columns are
ignored.  With fewer candidates than ``TOP`` all are returned.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.functions.materialize import freeze
from lapse.functions.ranking import with_positions
from lapse.llm.common import col, in_tasks
from lapse.llm.simhash_dedup import components

TOP, QUERY_STEP = 20, 20
DEGREE, SAMPLE, SETTLED = 32, 12, 0.01
TREES, LEAF, LEAF_BEST, CHANCE = 3, 192, 12, 24
BEAM, EXPAND, WIDE = 320, 40, 3 * TOP
BACK_FROM, BACK, ENTRIES = 8, 32, 8
BLOCK, ASKED_BLOCK = 1024, 256
GROUPS, SLICE = 256, 512  # groups, and rows of a search, that a task works on at once
SEED = 5
GRAPH = "node long, kind int, vec binary, ids array<long>, sims array<float>, fresh array<boolean>, vecs array<binary>"


# -- vectors -----------------------------------------------------------------------------------

def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, v): rows that take part, as arrays of doubles."""
    v = col(vec_col).cast("array<double>")
    rows = vectors.select(col(id_col).cast("long").alias("id"), v.alias("v"))
    good = F.col("id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.coalesce(good, F.lit(False)))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (common.n if common else 0))


def nodes(rows: DataFrame, top: int = TOP) -> DataFrame:
    """(node, v, members): distinct vectors, with the top + 1 smallest ids of their rows; written once."""
    salted = Window.partitionBy("v", "salt").orderBy("id")
    near = rows.withColumn("salt", F.pmod(F.hash("id"), F.lit(64))).withColumn("k", F.row_number().over(salted)).where(F.col("k") <= top + 1)
    near = near.withColumn("k", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("k") <= top + 1)
    lists = near.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("members")).withColumn("first", F.col("members")[0])
    return with_positions(lists, "first", "v", name="node").select("node", "v", "members")


def pack_vector(x: np.ndarray) -> bytes:
    """Scale and last component as 4 bytes each, then a signed byte for each other component."""
    scale = max(float(np.abs(x[:-1]).max()), 1e-30) / 127
    return np.array([scale, x[-1]], dtype=np.float32).tobytes() + np.rint(x[:-1] / scale).astype(np.int8).tobytes()


def unpack(packed: list[bytes]) -> np.ndarray:
    return floats(np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(len(packed), -1))


def floats(raw: np.ndarray) -> np.ndarray:
    """The vectors of packed rows (a matrix of bytes)."""
    head = raw[:, :8].copy().view(np.float32)
    return np.column_stack((raw[:, 8:].view(np.int8) * head[:, :1], head[:, 1]))


def packed_nodes(table: DataFrame) -> DataFrame:
    """(node, vec): augmented and packed vectors."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    longest = table.agg(F.coalesce(F.max(norm), F.lit(1.0))).first()[0]

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            v = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))
            more = np.sqrt(np.maximum(longest ** 2 - (v * v).sum(axis=1), 0))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([pack_vector(x) for x in np.column_stack((v, more))], type=pa.binary())], names=["node", "vec"])

    return in_tasks(table.select("node", "v"), run, "node long, vec binary")


# -- groups of a sorted partition ----------------------------------------------------------------

def runs(batches, keys: tuple[str, ...]):
    """Lists of rows (dicts) with equal keys, from Arrow batches sorted by them."""
    held, last = [], None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != last and held:
                yield held
                held = []
            held.append(row)
            last = key
    if held:
        yield held


def whole_groups(batches):
    """Arrow batches sorted by node, cut anew so that all rows of a node come in one."""
    import pyarrow as pa

    def together(parts):
        return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        node = batch.column("node").to_numpy()
        last = int(np.searchsorted(node, node[-1]))
        if last:
            yield together([*held, batch.slice(0, last)])
            held = []
        elif held and held[0].column("node")[0].as_py() != node[0]:
            yield together(held)
            held = []
        held.append(batch.slice(last))
    if held:
        yield together(held)


class Lists:
    """The list columns of a batch as flat arrays: of entry i, its row is ``row[i]``."""

    def __init__(self, batch):
        import pyarrow.compute as pc
        self.counts = pc.list_value_length(batch.column("ids")).to_numpy()
        self.row = np.repeat(np.arange(batch.num_rows), self.counts)
        self.ends = np.cumsum(self.counts)
        self.ids, self.sims = (batch.column(c).flatten().to_numpy() for c in ("ids", "sims"))
        self.fresh = batch.column("fresh").flatten().to_numpy(zero_copy_only=False)
        self.vecs = batch.column("vecs").flatten()

    def floors(self, rows: np.ndarray) -> np.ndarray:
        """What an offer to these rows has to beat: the last of a full list."""
        out = np.full(len(rows), -np.inf, np.float32)
        full = self.counts[rows] >= DEGREE
        out[full] = self.sims[self.ends[rows[full]] - 1]
        return out


def byte_rows(column) -> np.ndarray:
    """Binary values of one length as the rows of a matrix."""
    import pyarrow as pa
    if not len(column):
        return np.zeros((0, 9), np.uint8)
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(len(column), -1)


def binaries(raw: np.ndarray):
    import pyarrow as pa
    ends = (np.arange(len(raw) + 1) * raw.shape[1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))])


def graph_rows(node, kind: int, vec, counts, ids, sims, fresh, vecs):
    """A batch of GRAPH from flat lists, of which row i takes the next ``counts[i]`` entries."""
    import pyarrow as pa
    starts = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
    vec = pa.nulls(len(node), pa.binary()) if vec is None else vec.cast(pa.binary())
    lists = [pa.ListArray.from_arrays(starts, x) for x in (pa.array(ids, pa.int64()), pa.array(np.asarray(sims, np.float32)), pa.array(fresh, pa.bool_()), vecs.cast(pa.binary()))]
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(np.full(len(node), kind, np.int32)), vec, *lists],
                                      names=["node", "kind", "vec", "ids", "sims", "fresh", "vecs"])


def places(run: np.ndarray) -> np.ndarray:
    """Of sorted values, each one's place among its equals."""
    first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]][:len(run)])
    return np.arange(len(run)) - np.repeat(first, np.diff(np.r_[first, len(run)]))


def _offers(scores: np.ndarray, members: np.ndarray, ids: np.ndarray, raw: np.ndarray, best: int):
    """For the first members of each group a row with the best of its finite ``scores`` (group, asking, member)."""
    wide, asking = scores.shape[2], scores.shape[1]
    if wide > best:
        keep = np.argpartition(scores, wide - best, axis=2)[:, :, wide - best:]
    else:
        keep = np.broadcast_to(np.arange(wide), scores.shape)
    sims = np.take_along_axis(scores, keep, axis=2)
    good = np.isfinite(sims)
    counts = good.sum(axis=2)
    some = counts > 0
    if some.any():
        other = np.take_along_axis(np.broadcast_to(members[:, None, :], scores.shape), keep, axis=2)[good]
        yield graph_rows(ids[members[:, :asking]][some], 1, None, counts[some], ids[other], sims[good], np.ones(len(other), bool), binaries(raw[other]))


# -- the graph -----------------------------------------------------------------------------------

def first_offers(packed: DataFrame, n: int) -> DataFrame:
    """Offers from the leaves of random hyperplane trees and from groups by a hash."""
    bits = max(0, int(np.ceil(np.log2(max(n, 1) / (LEAF / 2)))))

    def leaves(batches):
        import pyarrow as pa
        for batch in batches:
            if not batch.num_rows:
                continue
            v = unpack(batch.column("vec").to_pylist())
            planes = np.random.default_rng(SEED).normal(size=(TREES, v.shape[1], bits))
            for tree in range(TREES):
                leaf = ((v @ planes[tree] > 0) @ (1 << np.arange(bits))).astype(np.int64) if bits else np.zeros(len(v), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), tree, "i4")), pa.array(leaf), batch.column("node"), batch.column("vec")],
                                                 names=["tree", "leaf", "node", "vec"])
            mixed = (batch.column("node").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
            group = (mixed % np.uint64(max(1, n // CHANCE))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), TREES, "i4")), pa.array(group), batch.column("node"), batch.column("vec")],
                                             names=["tree", "leaf", "node", "vec"])

    placed = in_tasks(packed, leaves, "tree int, leaf long, node long, vec binary")
    sizes = placed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n"))
    part = F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("n") / LEAF)).alias("part")
    dealt = placed.join(sizes, ["tree", "leaf"]).select("tree", "leaf", part, "node", "vec")
    dealt = dealt.repartition("tree", "leaf", "part").sortWithinPartitions("tree", "leaf", "part")

    def compare(batches):
        for run in runs(batches, ("tree", "leaf", "part")):
            for i in range(0, len(run), 4 * LEAF):  # the hash keeps parts near LEAF rows
                part = run[i:i + 4 * LEAF]
                raw = np.frombuffer(b"".join(r["vec"] for r in part), np.uint8).reshape(len(part), -1)
                scores = floats(raw) @ floats(raw).T
                np.fill_diagonal(scores, -np.inf)
                yield from _offers(scores[None], np.arange(len(part))[None], np.array([r["node"] for r in part]), raw, LEAF_BEST)

    return in_tasks(dealt, compare, GRAPH)


def _heads(batch) -> tuple[np.ndarray, np.ndarray]:
    """The own rows of a batch sorted by node, and for every row the number of its node's own row (-1: none there)."""
    node = batch.column("node").to_numpy()
    heads = np.flatnonzero(batch.column("kind").to_numpy() == 0)
    at = np.minimum(np.searchsorted(node[heads], node), max(len(heads) - 1, 0))
    return heads, np.where(node[heads][at] == node, at, -1) if len(heads) else np.full(len(node), -1)


def merged(rows_and_offers: DataFrame) -> DataFrame:
    """Own rows (kind 0) with the best of their neighbours and of what is offered to them (kind 1)."""
    def run(batches):
        for batch in whole_groups(batches):
            node, lists = batch.column("node").to_numpy(), Lists(batch)
            heads, at = _heads(batch)
            if not len(heads):
                continue
            e = np.flatnonzero((at[lists.row] >= 0) & (lists.ids != node[lists.row]))
            e = e[np.lexsort((e, lists.ids[e], at[lists.row[e]]))]  # of a neighbour named twice the first stays
            g = at[lists.row[e]]
            e = e[np.r_[True, (g[1:] != g[:-1]) | (lists.ids[e][1:] != lists.ids[e][:-1])][:len(e)]]
            e = e[np.lexsort((lists.ids[e], -lists.sims[e], at[lists.row[e]]))]
            e = e[places(at[lists.row[e]]) < DEGREE]
            yield graph_rows(node[heads], 0, batch.column("vec").take(heads), np.bincount(at[lists.row[e]], minlength=len(heads)),
                             lists.ids[e], lists.sims[e], lists.fresh[e], lists.vecs.take(e))

    return in_tasks(rows_and_offers.repartition("node").sortWithinPartitions("node", "kind"), run, GRAPH)


def _sampled(node: np.ndarray, group: np.ndarray, ids: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Which entries of lists are sampled: up to ``SAMPLE`` new and old ones of each (by a hash of both ends, so runs repeat)."""
    mixed = (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (ids.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.lexsort((ids, mixed >> np.uint64(20), fresh, group))
    out = np.zeros(len(ids), bool)
    out[order] = places(2 * group[order] + fresh[order]) < SAMPLE
    return out


def handed(graph: DataFrame) -> DataFrame:
    """Reverse edges: a row for each sampled neighbour, which holds the node, its vector and its floor."""
    def run(batches):
        for batch in batches:
            node, lists = batch.column("node").to_numpy(), Lists(batch)
            e = np.flatnonzero(_sampled(node[lists.row], lists.row, lists.ids, lists.fresh))
            row = lists.row[e]
            if len(e):
                yield graph_rows(lists.ids[e], 1, None, np.ones(len(e), int), node[row], lists.floors(row), lists.fresh[e], batch.column("vec").take(row))

    return in_tasks(graph, run, GRAPH)


def _compared(group, ids, raw, new, floor, asks, known):
    """Offers among the members of groups: rows sorted by group, in each first the node, then the others that ask."""
    place, vectors = places(group), floats(raw)
    for low in range(0, int(group[-1]) + 1, GROUPS):
        a, b = np.searchsorted(group, [low, low + GROUPS])
        grid = np.full((int(group[b - 1]) - low + 1, place[a:b].max() + 1), -1)
        grid[group[a:b] - low, place[a:b]] = np.arange(a, b)
        there, grid = grid >= 0, np.maximum(grid, 0)
        asking = there & asks[grid]
        most = int(asking.sum(axis=1).max())
        first = grid[:, :most]
        scores = vectors[first] @ vectors[grid].transpose(0, 2, 1)
        may = new[first][:, :, None] | new[grid][:, None, :]
        may[:, 0] = ~known[grid]  # the node knows its own neighbours
        may[:, :, 0] = False  # and those who ask know the node
        may &= asking[:, :most, None] & there[:, None, :]
        may[:, np.arange(most), np.arange(most)] = False
        scores[~may | (scores <= floor[first][:, :, None])] = -np.inf
        yield from _offers(scores, grid, ids, raw, SAMPLE)


def joined(graph: DataFrame, reverse: DataFrame) -> DataFrame:
    """Each node's own row (its sampled neighbours no longer new) and the offers among its members."""
    def run(batches):
        for batch in whole_groups(batches):
            node, lists = batch.column("node").to_numpy(), Lists(batch)
            heads, at = _heads(batch)
            if not len(heads):
                continue
            own = np.flatnonzero(np.isin(lists.row, heads))
            group = at[lists.row[own]]
            picked = _sampled(node[lists.row[own]], group, lists.ids[own], lists.fresh[own])
            yield graph_rows(node[heads], 0, batch.column("vec").take(heads), lists.counts[heads], lists.ids[own], lists.sims[own],
                             lists.fresh[own] & ~picked, lists.vecs.take(own))
            # The node itself and those that hand themselves over ask; their floors are known.
            back = np.flatnonzero((batch.column("kind").to_numpy() == 1) & (at >= 0))
            back = back[np.lexsort((back, lists.fresh[lists.ends[back] - 1], at[back]))]  # rows of one entry
            back = back[places(2 * at[back] + lists.fresh[lists.ends[back] - 1]) < 2 * SAMPLE]
            entry, near = lists.ends[back] - 1, own[picked]
            ids = np.concatenate((node[heads], lists.ids[entry], lists.ids[near]))
            g = np.concatenate((np.arange(len(heads)), at[back], group[picked]))
            kind = np.repeat([0, 1, 2], [len(heads), len(back), len(near)])
            codes = np.unique(np.concatenate((ids, lists.ids[own])), return_inverse=True)[1]
            codes, listed = codes[:len(ids)], codes[len(ids):]
            known = np.isin(g * (codes.max() + 1 + listed.max(initial=0)) + codes, group * (codes.max() + 1 + listed.max(initial=0)) + listed)
            raw = np.concatenate([x for x in (byte_rows(batch.column("vec").take(heads)), byte_rows(lists.vecs.take(entry)), byte_rows(lists.vecs.take(near))) if len(x)])
            new = np.concatenate((np.zeros(len(heads), bool), lists.fresh[entry], lists.fresh[near]))
            floor = np.concatenate((lists.floors(heads), lists.sims[entry], np.full(len(near), np.inf, np.float32)))
            order = np.lexsort((kind, ids, g))
            order = order[np.r_[True, (g[order][1:] != g[order][:-1]) | (ids[order][1:] != ids[order][:-1])]]
            order = order[np.lexsort((order, g[order]))]
            yield from _compared(g[order], ids[order], raw[order], new[order], floor[order], kind[order] < 2, known[order])

    # Which reverse edges a node takes is decided by a hash, not by who comes first.
    together = graph.unionByName(reverse).withColumn("turn", F.xxhash64("node", F.get("ids", F.lit(0))))
    together = together.repartition("node").sortWithinPartitions("node", "kind", "turn").drop("turn")
    return in_tasks(together, run, GRAPH)


def _drop_unused(df: DataFrame) -> None:
    """Let Spark's cleaner remove the shuffle files and checkpoints of finished rounds: it does so when
    the driver's objects for them are collected, which a driver with little to do may not do for long."""
    import gc
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def build(packed: DataFrame) -> DataFrame:
    """The neighbour graph: (node, vec, ids, sims, vecs), nearest first, checkpointed."""
    packed = freeze(packed)
    n = packed.count()
    empty = [F.array().cast(t).alias(c) for c, t in (("ids", "array<long>"), ("sims", "array<float>"), ("fresh", "array<boolean>"), ("vecs", "array<binary>"))]
    own = packed.select("node", F.lit(0).alias("kind"), "vec", *empty)
    graph = freeze(merged(own.unionByName(first_offers(packed, n))))
    before = None
    while True:
        graph = freeze(merged(joined(graph, handed(graph))))
        _drop_unused(graph)
        new = graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x)))).first()[0] or 0
        # Lists only improve; a round that leaves as many new edges as the one before changes them no more.
        if new <= SETTLED * n * DEGREE or new == before:
            return graph
        before = new


# -- search ----------------------------------------------------------------------------------------

def both_ways(graph: DataFrame) -> DataFrame:
    """(at, ids, vecs): the graph with edges back from a node's ``BACK_FROM`` nearest.

    A node that no list names could not be reached.  A node takes at most ``BACK`` such edges, those of
    the nodes that the fewest lists name first.
    """
    named = graph.select(F.explode("ids").alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    back = graph.select("node", "vec", F.explode(F.slice("ids", 1, BACK_FROM)).alias("at")).join(named, "node", "left")
    rare = Window.partitionBy("at").orderBy(F.coalesce("n", F.lit(0)), "node")
    back = back.withColumn("k", F.row_number().over(rare)).where(F.col("k") <= BACK)
    lists = back.groupBy("at").agg(F.collect_list(F.struct("node", "vec")).alias("back"))
    met = graph.select(F.col("node").alias("at"), "ids", "vecs").join(lists, "at", "left")
    more = F.coalesce("back", F.array().cast("array<struct<node:long,vec:binary>>"))
    return met.select("at", F.concat("ids", F.transform(more, lambda x: x["node"])).alias("ids"),
                      F.concat("vecs", F.transform(more, lambda x: x["vec"])).alias("vecs"))


def bridges(graph: DataFrame) -> DataFrame:
    """(at, ids, vecs): edges, in both directions, that join the components of the graph.

    The smallest node of every component goes into a graph of its own, until one component is left.
    """
    level, out = graph, graph.select(F.col("node").alias("at"), "ids", "vecs").limit(0)
    while True:
        parts = components(level.select(F.col("node").alias("a"), F.explode(F.slice("ids", 1, BACK_FROM)).alias("b")))
        heads = level.select("node", "vec").join(parts, "node", "left").where(F.coalesce("component", "node") == F.col("node"))
        heads = freeze(heads.select("node", "vec"))
        if heads.count() < 2:
            return out
        level = build(heads)
        there = level.select(F.col("node").alias("at"), "ids", "vecs")
        back = level.select(F.explode("ids").alias("at"), F.array("node").alias("ids"), F.array("vec").alias("vecs"))
        out = out.unionByName(there).unionByName(back)


def _scores(q: np.ndarray, own, v: np.ndarray, step) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of queries with as many others, and six standard errors of each.

    The query's added component is zero, so products are inner products.  A component is off by up to half a
    step, evenly, on either side: a standard error of a step over the root of 12.
    """
    q, v = q[:, :-1], v[:, :-1]
    errors = 6 / np.sqrt(12) * (np.sqrt((q * q).sum(axis=1)) * step + own * np.sqrt((v * v).sum(axis=1)))
    return np.einsum("ij,ij->i", q, v), errors


def steps(raw: np.ndarray) -> np.ndarray:
    """The scales of packed rows."""
    return raw[:, :4].copy().view(np.float32)[:, 0].astype(float)


def search(graph: DataFrame, starts: DataFrame) -> DataFrame:
    """(node, found): for every start node the ids of its best list, best first."""
    edges = both_ways(graph).unionByName(bridges(graph)).repartition("at").persist()
    # sqrt(nodes) of them, by a hash, are known to every task.
    some = graph.select("node", "vec").where(F.pmod(F.xxhash64("node"), F.lit(int(graph.count() ** 0.5) + 1)) == 0).collect()
    sent = graph.sparkSession.sparkContext.broadcast(
        ([r.node for r in some], np.frombuffer(b"".join(bytes(r.vec) for r in some), np.uint8).reshape(max(1, len(some)), -1)))

    def begin(batches):
        import pyarrow as pa
        entry_ids, entry_raw = sent.value
        entries = floats(entry_raw) if len(entry_ids) else None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                asked = np.frombuffer(r["vec"], np.uint8)[None]
                q, own, known = floats(asked), steps(asked), {}
                near = np.frombuffer(b"".join(r["vecs"]), np.uint8).reshape(len(r["ids"]), -1) if r["ids"] else None
                for ids, v, raw, most in ((r["ids"], near is not None and floats(near), near, len(r["ids"])), (entry_ids, entries, entry_raw, ENTRIES)):
                    if len(ids):
                        sims, errors = _scores(np.broadcast_to(q, v.shape), own, v, steps(raw))
                        known |= {int(ids[i]): (float(sims[i]), float(errors[i])) for i in np.argsort(-sims, kind="stable")[:most]}
                known.pop(r["node"], None)
                out.append(sorted(({"s": -x, "id": i, "done": False, "e": e} for i, (x, e) in known.items()), key=lambda x: (x["s"], x["id"])))
            lists = pa.array(out, type=pa.list_(pa.struct([("s", pa.float32()), ("id", pa.int64()), ("done", pa.bool_()), ("e", pa.float32())])))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("vec"), lists], names=["node", "vec", "beam"])

    own = graph.join(starts, "node", "left_semi").select("node", "vec", "ids", "vecs")
    beam = freeze(in_tasks(own, begin, "node long, vec binary, beam array<struct<s:float,id:long,done:boolean,e:float>>"))

    def score(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column("ids")).to_numpy())
            raw, asked = byte_rows(batch.column("vecs").flatten()), byte_rows(batch.column("vec"))
            if not len(raw):
                continue
            sims, errors = _scores(floats(asked)[row], steps(asked)[row], floats(raw), steps(raw))
            e = np.flatnonzero(sims > batch.column("least").to_numpy()[row])
            yield pa.RecordBatch.from_arrays([batch.column("node").take(row[e]), batch.column("ids").flatten().take(e), pa.array(sims[e].astype(np.float32)),
                                              pa.array(errors[e].astype(np.float32))], names=["node", "id", "sim", "e"])

    while True:
        chosen = beam.withColumn("go", F.slice(F.filter("beam", lambda x: ~x["done"]), 1, EXPAND))
        least = F.when(F.size("beam") >= BEAM, -F.element_at("beam", -1)["s"]).otherwise(F.lit(float("-inf")).cast("float"))
        front = chosen.select("node", "vec", least.alias("least"), F.explode("go.id").alias("at"))
        found = in_tasks(front.join(edges, "at").select("node", "vec", "least", "ids", "vecs"), score, "node long, id long, sim float, e float")
        seen = chosen.select("node", F.explode("beam").alias("x"), F.col("go.id").alias("went")).select(
            "node", F.col("x.id").alias("id"), F.col("x.s").alias("s"), (F.col("x.done") | F.array_contains("went", F.col("x.id"))).alias("done"), F.col("x.e").alias("e"))
        every = seen.unionByName(found.where("id <> node").select("node", "id", (-F.col("sim")).alias("s"), F.lit(False).alias("done"), "e"))
        # One row per node and id; scores of the same pair are the same number.
        one = every.groupBy("node", "id").agg(F.min("s").alias("s"), F.max("done").alias("done"), F.max("e").alias("e"))
        lists = one.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("s", "id", "done", "e"))), 1, BEAM).alias("beam"))
        beam = beam.select("node", "vec").join(lists, "node", "left")  # a list may be empty
        beam = freeze(beam.withColumn("beam", F.coalesce("beam", F.array().cast(beam.schema["beam"].dataType))))
        if not beam.where(F.exists("beam", lambda x: ~x["done"])).limit(1).count():
            break  # every list is expanded: nothing better was found
    edges.unpersist()
    return beam.select("node", "beam")


def within_bounds(found: DataFrame, top: int) -> DataFrame:
    """(node, found, open): the entries of a list that may be among its ``top`` best, and whether there may be more."""
    lows = F.reverse(F.array_sort(F.transform("beam", lambda x: -x["s"] - x["e"])))
    floor = F.when(F.size("beam") >= top, F.get(lows, F.lit(top - 1))).otherwise(F.lit(float("-inf")))
    widest = F.array_max(F.transform("beam", lambda x: x["e"]))
    last = -F.element_at("beam", -1)["s"] + widest
    ends_inside = (F.size("beam") >= BEAM) & (F.when(F.size("beam") > 0, last) >= F.col("floor"))
    marked = found.withColumn("floor", floor.cast("double")).withColumn(
        "found", F.transform(F.filter("beam", lambda x: -x["s"] + x["e"] >= F.col("floor")), lambda x: x["id"]))
    return marked.select("node", "found", (F.coalesce(ends_inside, F.lit(False)) | ((F.size("found") > WIDE) & (F.size("beam") > top))).alias("open"))


def _compare_blocks(batches, top: int):
    """For every asked node of a pair of blocks, the ``top`` best nodes (ties to the smaller)."""
    import pyarrow as pa

    def side(batch, name, i):
        rows = batch.column(name).slice(i, 1).flatten()
        v = rows.field("v").flatten().to_numpy()
        return rows.field("node").to_numpy(), v.reshape(len(rows), -1)

    for batch in batches:
        for i in range(batch.num_rows):
            (asked, q), (ids, v) = side(batch, "asked", i), side(batch, "block", i)
            order = np.argsort(ids)
            ids, scores = ids[order], q @ v[order].T
            best = np.argsort(-scores, axis=1, kind="stable")[:, :top]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(asked, best.shape[1])), pa.array(ids[best].ravel()),
                                              pa.array(np.take_along_axis(scores, best, axis=1).ravel())], names=["node", "other", "score"])


def exact_others(table: DataFrame, starts: DataFrame, top: int = TOP) -> DataFrame:
    """(node, other): for every start node the top + 1 best of all nodes, by blocks of products."""
    def blocks(rows, size, name):
        pick = F.pmod(F.xxhash64("node"), F.lit(max(1, -(-rows.count() // size))))
        return rows.groupBy(pick.alias("part")).agg(F.collect_list(F.struct("node", "v")).alias(name)).select(name)

    whole = table.select("node", "v")
    pairs = blocks(whole, BLOCK, "block").crossJoin(blocks(whole.join(starts, "node", "left_semi"), ASKED_BLOCK, "asked"))
    found = in_tasks(pairs, lambda batches: _compare_blocks(batches, top + 1), "node long, other long, score double")
    ranked = found.withColumn("k", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "other")))
    return ranked.where(F.col("k") <= top + 1).select("node", "other")


def ranked(table: DataFrame, pairs: DataFrame, top: int = TOP) -> DataFrame:
    """(node, best): rows of the candidate nodes ``other``, scored on the original vectors, the top + 1 best."""
    pairs = pairs.join(table.select("node", F.col("v").alias("q")), "node").join(
        table.select(F.col("node").alias("other"), "v", "members"), "other").select("node", "q", "v", "members", "other")

    def exact(batches):
        import pyarrow as pa
        for batch in batches:
            q, v = (batch.column(c).flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1)) for c in "qv")
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("members"), batch.column("other"), pa.array((q * v).sum(axis=1))],
                                             names=["node", "members", "other", "score"])

    scored = in_tasks(pairs, exact, "node long, members array<long>, other long, score double").select("node", F.explode("members").alias("vec_id"), "score", "other")
    order = Window.partitionBy("node").orderBy(F.desc("score"), "vec_id", "other")
    best = scored.withColumn("k", F.row_number().over(order)).where(F.col("k") <= top + 1)
    return best.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("k", "vec_id", "score", "other"))).alias("best"))


def nearest(vectors: DataFrame, query: Column, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``query`` (over the column id) holds."""
    rows = freeze(usable(vectors, id_col, vec_col))
    table = nodes(rows, top)
    graph = build(packed_nodes(table))
    asked = rows.where(query).join(table.select("node", "v"), "v").select("id", "node")
    starts = asked.select("node").distinct()
    found = freeze(within_bounds(search(graph, starts), top))
    # The node itself stands for other rows with the same vector.
    pairs = found.where("NOT open").select("node", F.explode(F.concat(F.array("node"), "found")).alias("other"))
    lists = freeze(ranked(table, pairs, top))
    full = min(top + 1, table.agg(F.coalesce(F.sum(F.size("members")), F.lit(0))).first()[0])
    rest = found.where("open").select("node").unionByName(lists.where(F.size("best") < full).select("node"))
    if rest.limit(1).count():
        lists = lists.where(F.size("best") >= full).unionByName(ranked(table, exact_others(table, rest, top), top))
    # Of a query's list its own row goes: one entry of its node and id (a copy of the row stays).
    found_rows = asked.join(lists, "node")
    own = F.array_position(F.transform("best", lambda x: (x["vec_id"] == F.col("id")) & (x["other"] == F.col("node"))), True)
    answers = found_rows.withColumn("_own", own).select("id", F.slice(F.filter("best", lambda x, i: i + 1 != F.col("_own")), 1, top).alias("best"))
    return answers.select(F.col("id").alias("query_id"), F.posexplode("best").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def ann_search(vectors: DataFrame) -> DataFrame:
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    return nearest(vectors, F.col("id") % QUERY_STEP == 0)
