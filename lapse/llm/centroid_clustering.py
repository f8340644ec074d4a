"""Centroid clustering in exact integers, with heap-ordered bounds.

Every vector has an upper bound of the distance to its own centroid and a lower bound of the distance to any other.
While the gap between them is not used up, the vector cannot change its cluster.  Centroids that move by some
drift use up at most the drift of the own centroid plus the largest drift of the others; that sum is the same for
all vectors of a cluster, so it is accumulated once per cluster.  A vector enters its cluster's heap with
``gap + accumulated drift``; a round pops only the entries at or under the drift accumulated by then, rescans their
vectors exactly against all centroids, and pushes them again.  Bounds are floats, rounded to the safe side; every
assignment comes from an exact integer scan, so the result is that of assigning every vector in every round.

How it runs: vectors are packed into blocks of ``BLOCK_ROWS``, written once.  A block's state is its assignments and
one heap per cluster, about 16 bytes a vector.  A round is one job over the pairs of block and state, which are read
side by side without a shuffle, however many blocks a partition has (``side_by_side``); it writes the new state and, per task, the change of the clusters' sums and counts,
which Spark adds up to K x 65 numbers.  A lost executor rereads written blocks and state.

Results for odd input: vectors that are null, of another length, or hold a null or non-finite component take no
part (nor do components whose integer passes 62 bits: no long holds their distances); equal vectors and repeated ids
are vectors of their own; a null id hashes as the empty text; equal hashes are ordered by their components; with
fewer kept vectors than centroids each is a centroid; an empty table gives an empty result; distances and inertias
beyond a long are given as the largest long; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.functions.materialize import freeze
from lapse.llm.common import col, in_tasks, ship_package

K, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, 3
BLOCK_ROWS = 512
LARGEST = 2**63 - 1
# Relative slack of the float bounds, far over the error of the few operations behind each.
SLACK = 1e-12
SMALL = 2**27  # components up to this size have 64-dimensional squared distances that fit a long
STATE = "state binary, moved array<decimal(38,0)>"


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(id, v): the kept vectors as floor(scale * component)."""
    plain = vectors.select(col(id_col).alias("id"), col(vector_col).cast("array<double>").alias("x"))
    whole = (F.size("x") == dims) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(2.0**62 / scale)))
    return plain.filter(F.col("x").isNotNull()).filter(whole).select("id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors of smallest hash (k rows on the driver)."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [list(r["v"]) for r in kept.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()]


def vector_blocks(kept: DataFrame, dims: int) -> DataFrame:
    """(ids, width, v): up to BLOCK_ROWS vectors as bytes of the narrowest integers that hold them."""
    id_type = kept.schema["id"].dataType.simpleString()

    def pack(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = flat[at:at + BLOCK_ROWS]
                width = next(w for w in (2, 4, 8) if w == 8 or np.abs(part).max(initial=0) < 2 ** (8 * w - 1))
                ids = batch.column("id").slice(at, BLOCK_ROWS)
                yield pa.record_batch({"ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                                       "width": pa.array([width], pa.int32()), "v": pa.array([part.astype(f"<i{width}").tobytes()], pa.binary())})

    return in_tasks(kept, pack, f"ids array<{id_type}>, width int, v binary")


def _matrix(width: int, raw: bytes, dims: int):
    import numpy as np
    part = np.frombuffer(raw, f"<i{width}").reshape(-1, dims).astype(np.int64)
    return part if np.abs(part).max(initial=0) <= SMALL else part.astype(object)


def _distances(part, centroids: list[list[int]]):
    """Exact squared distances, (vectors x centroids)."""
    import numpy as np
    small = part.dtype != object and max(abs(c) for row in centroids for c in row) <= SMALL
    kind = np.int64 if small else object
    own = part.astype(kind)
    return np.stack([((own - np.array(row, dtype=kind)) ** 2).sum(axis=1) for row in centroids], axis=1)


class BlockState:
    """Assignments of a block and one heap of (key, vector) per cluster."""

    def __init__(self, rows: int, k: int, raw: bytes | None):
        import numpy as np
        self.k = k
        if raw is None:
            self.cluster, self.heaps = np.full(rows, -1, np.int32), [[] for _ in range(k)]
            return
        sizes = np.frombuffer(raw, "<i4", k)
        self.cluster = np.frombuffer(raw, "<i4", rows, 4 * k).copy()
        members = np.frombuffer(raw, "<i4", sizes.sum(), 4 * (k + rows))
        keys = np.frombuffer(raw, "<f8", sizes.sum(), 4 * (k + rows + len(members)))
        ends = np.cumsum(sizes)
        # A heap written in its order is a heap when read.
        self.heaps = [list(zip(keys[e - s:e].tolist(), members[e - s:e].tolist())) for s, e in zip(sizes.tolist(), ends.tolist())]

    def raw(self) -> bytes:
        import numpy as np
        entries = [e for heap in self.heaps for e in heap]
        return b"".join((np.array([len(h) for h in self.heaps], "<i4").tobytes(), self.cluster.astype("<i4").tobytes(),
                         np.array([m for _, m in entries], "<i4").tobytes(), np.array([x for x, _ in entries], "<f8").tobytes()))

    def expired(self, used: list[float]) -> list[int]:
        """Pop the vectors whose gap is used up."""
        out = []
        for heap, drift in zip(self.heaps, used):
            while heap and heap[0][0] * (1 - SLACK) <= drift:
                out.append(heapq.heappop(heap)[1])
        return out

    def rescan(self, picked: list[int], distances, used: list[float]):
        """Assign the picked vectors by their exact distances; returns their clusters before and now."""
        import numpy as np
        now = np.argmin(distances, axis=1)  # the first of equal distances has the smaller number
        before = self.cluster[picked]
        self.cluster[picked] = now
        roots = np.sqrt(distances.astype(np.float64))
        at = np.arange(len(picked))
        upper = roots[at, now] * (1 + SLACK)
        roots[at, now] = np.inf
        gaps = roots.min(axis=1) * (1 - SLACK) - upper
        for gap, c, i in zip(gaps.tolist(), now.tolist(), picked):
            heapq.heappush(self.heaps[c], (gap + used[c], i))
        return before, now


def _round(pairs, centroids: list[list[int]], used: list[float], dims: int) -> Iterator[tuple]:
    """One round over a task's blocks: new states, and with the last the change of sums and counts."""
    import numpy as np
    k = len(centroids)
    moved = np.zeros((k, dims + 1), dtype=object)
    held = None
    for (width, raw), state in pairs:
        rows = len(raw) // (width * dims)
        block = BlockState(rows, k, state)
        picked = list(range(rows)) if state is None else block.expired(used)
        if picked:
            part = _matrix(width, raw, dims)[picked]
            before, now = block.rescan(picked, _distances(part, centroids), used)
            for c in range(k):
                for sign, member in ((1, (now == c) & (before != c)), (-1, (before == c) & (now != c))):
                    if member.any():
                        moved[c, :dims] += sign * part[member].astype(object if part.dtype == object else np.int64).sum(axis=0).astype(object)
                        moved[c, dims] += sign * int(member.sum())
        if held is not None:
            yield held, None
        held = block.raw()
    if held is not None:
        yield held, [Decimal(int(x)) for x in moved.ravel()]


def side_by_side(left: DataFrame, right: DataFrame):
    """Pairs of the rows of two tables with the same partitions and as many rows in each.

    ``DataFrame.rdd`` hands rows over in batches that follow their bytes, and ``zip`` pairs batch with batch: blocks
    and their much smaller states would part ways in a partition of more than one batch.  Mapped rows are dealt into
    batches of equally many rows on both sides.
    """
    return left.rdd.map(tuple).zip(right.rdd.map(tuple))


def _drift_up(old: list[int], new: list[int]) -> float:
    return math.sqrt(sum((a - b) ** 2 for a, b in zip(old, new))) * (1 + SLACK)


def cluster_blocks(blocks: DataFrame, centroids: list[list[int]], rounds: int = ROUNDS, dims: int = DIMS):
    """(state of the blocks after the last assignment, final centroids)."""
    spark = blocks.sparkSession
    ship_package(spark)
    k = len(centroids)
    used = [0.0] * k
    totals = [[0] * (dims + 1) for _ in range(k)]
    matrices = blocks.select("width", "v")
    state = blocks.select(F.lit(None).cast("binary").alias("state"))
    for i in range(rounds + 1):
        pairs = side_by_side(matrices, state.select("state"))
        at, drift = centroids, list(used)
        step = pairs.mapPartitions(lambda rows, at=at, drift=drift: _round(
            (((m[0], bytes(m[1])), None if s[0] is None else bytes(s[0])) for m, s in rows), at, drift, dims))
        state = freeze(spark.createDataFrame(step, STATE, verifySchema=False))
        if i == rounds:
            break
        change = state.filter("moved IS NOT NULL").select(F.posexplode("moved").alias("at", "by")).groupBy("at").agg(F.sum("by").alias("by"))
        for r in change.collect():  # k * (dims + 1) rows
            totals[r["at"] // (dims + 1)][r["at"] % (dims + 1)] += int(r["by"])
        centroids = [[s // t[dims] for s in t[:dims]] if t[dims] else old for t, old in zip(totals, centroids)]
        drifts = [_drift_up(a, b) for a, b in zip(at, centroids)]
        if not any(drifts):
            break  # a fixed point: the remaining rounds would change nothing
        used = [(u + d + max([x for j, x in enumerate(drifts) if j != c], default=0.0)) * (1 + SLACK) for c, (u, d) in enumerate(zip(used, drifts))]
    return state, centroids


def centroid_clustering(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
                        rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    spark = vectors.sparkSession
    kept = integer_vectors(vectors, id_col, vector_col, dims, scale)
    id_type = kept.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, cluster int, distance long"
    start = first_centroids(kept, k, seed)
    if start:
        blocks = freeze(vector_blocks(kept, dims))
        state, centroids = cluster_blocks(blocks, start, rounds, dims)

        def assigned(rows) -> Iterator[tuple]:
            for (ids, width, raw), (own,) in rows:
                part = _matrix(width, bytes(raw), dims)
                cluster = BlockState(len(ids), len(centroids), bytes(own)).cluster
                for c in range(len(centroids)):
                    picked = (cluster == c).nonzero()[0]
                    if len(picked):
                        far = _distances(part[picked], [centroids[c]])[:, 0]
                        for i, d in zip(picked.tolist(), far.tolist()):
                            yield ids[i], c, min(d, LARGEST)

        found = freeze(spark.createDataFrame(side_by_side(blocks, state.select("state")).mapPartitions(assigned), schema, verifySchema=False))
        marks = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids)]
    else:
        found, marks = spark.createDataFrame([], schema), []
    by_cluster = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"))

    def fit(name: str):
        return F.least(F.col(name), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")

    names = spark.createDataFrame(marks, "cluster int, centroid_sha256 string")
    # At most k rows.
    side = by_cluster.withColumn("whole", F.sum("total").over(Window.partitionBy())).join(names, "cluster").select(
        "cluster", fit("total").alias("cluster_inertia"), fit("whole").alias("inertia"), "centroid_sha256")
    return found.join(F.broadcast(side), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
