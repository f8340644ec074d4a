"""Near-duplicates by SimHash fingerprints with pivot distance tables.

1. ``fingerprints`` hashes the three-word shingles of every text (XXH64, seed 42) and takes the
   majority of every bit.
2. Equal fingerprints become one class; only the distinct ones go on.
3. Every distinct fingerprint gets a row of the pivot table: its Hamming distances to
   ``N_PIVOTS`` reference fingerprints.
4. 64 bits are cut into 6 blocks.  Two fingerprints that differ in at most 3 bits agree in 3
   whole blocks, so both have one of the C(6, 3) = 20 keys in common.  Rows meet on such a key;
   a key with more rows than ``TILE`` is cut into tiles, and every pair of tiles meets.
5. Within a key, rows are sorted by the first pivot distance and compared at growing offsets:
   a pair goes on only while the largest difference of its pivot distances is at most 3 (the
   triangle inequality: no linked pair is lost), and is verified by its differing bits.  Of the
   links found only a spanning forest leaves the task, so a group of n rows gives at most n - 1.
6. Components come from rounds of minimum labels and pointer jumping over checkpointed tables.

Results for odd input: null and empty texts have fingerprint zero and are linked like any other;
texts of any length are hashed whole; rows with a null id keep their fingerprint but take no part in choosing a component id, which is
null if no linked row has an id; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.functions.materialize import freeze
from lapse.llm.common import col, fresh, in_tasks, text_or_empty

SHINGLE, MAX_BITS = 3, 3
N_PIVOTS, TILE = 16, 4096
SALTS = 32  # shares into which the pairs of one node are dealt
# Blocks of bits (first bit, width).
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))


def _majority(text: str, seed: int = 42) -> int:
    import xxhash

    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(b" ".join(tokens), seed)]
    else:
        joined, ends = b" ".join(tokens), np.cumsum([len(t) + 1 for t in tokens])
        first = [0, *ends[:-SHINGLE].tolist()]
        hashes = [xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(first, (ends[SHINGLE - 1:] - 1).tolist())]
    bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = np.array(hashes[i:i + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp): the fingerprint as a signed long, one row per input row."""
    text = text_or_empty(text_col)
    source = docs.select(col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            found = np.array([_majority(t) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), pa.array(found.view(np.int64))],
                                             names=["id", "text_hash", "fp"])

    return in_tasks(source, run, f"id {source.schema['id'].dataType.simpleString()}, text_hash long, fp long")


def pivots(n: int = N_PIVOTS) -> list[int]:
    """Reference fingerprints, spread by a multiplicative rule (signed longs)."""
    return [((i * 0x9E3779B97F4A7C15 ^ (i * 0xD1B54A32D192ED03 >> 7)) + (1 << 63)) % (1 << 64) - (1 << 63) for i in range(1, n + 1)]


def pivot_table(fps: DataFrame) -> DataFrame:
    """``fps`` with ``d``: an array of the Hamming distances to every pivot."""
    return fps.withColumn("d", F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("tinyint") for p in pivots()]))


def _keys() -> list:
    """Per choice of three blocks: the choice's number and the bits of those blocks."""
    out = []
    for i, chosen in enumerate(combinations(BLOCKS, 3)):
        mask = sum(((1 << width) - 1) << first for first, width in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        out.append(F.struct(F.lit(i).cast("tinyint").alias("choice"), F.col("fp").bitwiseAND(F.lit(signed)).alias("bits")))
    return out


def links(table: DataFrame) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints ``fp`` of a table that differ in 1 to 3 bits.

    Every pair within the limit is connected through the links returned (a forest per key and tile pair).
    """
    meeting = table.select("fp", F.inline(F.array(*_keys())))
    sizes = meeting.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Most keys have one row, which ends here; the others take their distances along.
    meeting = pivot_table(meeting.join(sizes, ["choice", "bits"]))
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    # A row of tile t meets tile u in the cell (min, max) of the two.
    cells = F.when(F.col("n") <= TILE, F.array(F.lit(0))).otherwise(
        F.transform(F.sequence(F.lit(0), tiles - 1), lambda u: F.least(u, own) * tiles + F.greatest(u, own)))
    placed = meeting.select("choice", "bits", F.explode(cells).alias("cell"), "fp", "d")
    placed = placed.repartition("choice", "bits", "cell").sortWithinPartitions("choice", "bits", "cell", F.col("d")[0])
    return in_tasks(placed, _forest, "a long, b long")


def _forest(batches):
    """Links within every run of equal (choice, bits, cell) of a sorted partition."""
    import pyarrow as pa

    held = None
    for batch in _and_end(batches):
        part = None if batch is None else _columns(batch)
        rows = part if held is None else held if part is None else tuple(np.concatenate(x) for x in zip(held, part))
        if rows is None or not len(rows[0]):
            continue
        # The last run may go on in the next batch.
        cut = len(rows[0]) if batch is None else _last_run(rows[0])
        held = tuple(x[cut:] for x in rows)
        if cut:
            a, b = _compare(*(x[:cut] for x in rows))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _and_end(batches):
    yield from batches
    yield None


def _columns(batch):
    d = batch.column("d")
    flat = d.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    keys = np.empty(batch.num_rows, dtype=[("choice", "i1"), ("bits", "i8"), ("cell", "i4")])
    for name in ("choice", "bits", "cell"):
        keys[name] = batch.column(name).to_numpy()
    return keys, batch.column("fp").to_numpy(), flat


def _last_run(keys) -> int:
    """Index at which the run of the last key begins."""
    other = np.flatnonzero(keys != keys[-1])
    return int(other[-1]) + 1 if len(other) else 0


def _compare(keys, fp, d):
    """Spanning links of sorted rows: pivots discard, bits verify, connected pairs are skipped."""
    n = len(fp)
    run = np.cumsum(np.r_[0, keys[1:] != keys[:-1]])
    label = np.arange(n)
    a_out, b_out = [], []
    left, step = np.arange(n), 0
    while True:
        step += 1
        left = left[left + step < n]
        right = left + step
        near = (run[left] == run[right]) & (d[right, 0] - d[left, 0] <= MAX_BITS)
        left = left[near]
        if not len(left):
            break
        apart = left[label[left] != label[left + step]]
        for i in range(0, len(apart), 1 << 18):
            x = apart[i:i + (1 << 18)]
            y = x + step
            x = x[np.abs(d[x] - d[y]).max(axis=1) <= MAX_BITS]
            y = x + step
            x = x[np.bitwise_count((fp[x] ^ fp[y]).view(np.uint64)) <= MAX_BITS]
            for p in x.tolist():
                root, other = _find(label, p), _find(label, p + step)
                if root != other:
                    label[max(root, other)] = min(root, other)
                    a_out.append(fp[p])
                    b_out.append(fp[p + step])
        if len(apart):
            while True:  # point every row at its root
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return np.array(a_out, dtype=np.int64), np.array(b_out, dtype=np.int64)


def _find(label, i):
    while label[i] != i:
        label[i] = label[label[i]]
        i = label[i]
    return i


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): pairs (u, v) with the smallest v of each u.

    A u may hold a third of all pairs: minima are taken per (u, salt) first, and the minimum of u goes back to the
    salts that occur, so no task gets more than a share of a u.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    shares = salted.groupBy("u", "salt").agg(F.min("v").alias("m"))
    least = shares.groupBy("u").agg(F.min("m").alias("m"), F.collect_list("salt").alias("salts"))  # at most SALTS a u
    return salted.join(least.select("u", F.explode("salts").alias("salt"), "m"), ["u", "salt"]).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of undirected ``edges`` (a, b): the smallest node reachable.

    Alternates two star rounds over checkpointed edge tables until nothing changes: every node
    hands its larger neighbours to its smallest one, then its smaller ones likewise.  A round's
    table has at most as many rows as the edges, the number of rounds grows with the logarithm
    of the longest chain.
    """
    current = freeze(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        if before and not before[0]:
            break
        both = current.union(current.select("v", "u"))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = (_with_least(large).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                           F.col("m").alias("v"))).where("u <> v").distinct()
        current = freeze(small)
        state = current.agg(F.count(F.lit(1)), F.sum(F.col("u").cast("decimal(20,0)")), F.sum(F.col("v").cast("decimal(20,0)")),
                            F.sum(F.hash("u", "v"))).first()
        if state == before:
            break
        before = state
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp, part, component): one row per input row.

    part is the smallest fingerprint linked, component the smallest id reachable.
    """
    rows = freeze(fingerprints(docs, id_col, text_col))
    classes = freeze(rows.groupBy("fp").agg(F.min("id").alias("least_id")))
    found = components(links(classes))
    part = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    part = part.select("fp", "least_id", F.coalesce("component", "fp").alias("part"))
    smallest = part.groupBy("part").agg(F.min("least_id").alias("component"))
    named = part.join(smallest, "part").select("fp", "part", "component")
    return rows.join(named, "fp").select("id", "text_hash", "fp", "part", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without near duplicates: exactly one row of each component stays.

    It has the smallest id (null if no row has one) and, of that id's texts, the smallest text hash.  Of rows
    that repeat both, one stays.  All columns come out as they came.
    """
    names = fresh(docs, "_kept_hash", "_kept_null", "_kept_id")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first")
    kept = near_duplicates(docs, id_col, text_col).groupBy("part").agg(first).select("first.*")

    def marks(text_hash, doc_id):
        return dict(zip(names, (text_hash, doc_id.isNull(), F.coalesce(doc_id.cast("string"), F.lit("")))))

    kept = kept.select(*[c.alias(n) for n, c in marks(F.col("text_hash"), F.col("id")).items()])
    # Repeats end in the tasks that read them; the join uses the same exchange.
    marked = docs.withColumns(marks(F.xxhash64(text_or_empty(text_col)), col(id_col))).dropDuplicates(names)
    return marked.join(kept, names, "left_semi").select(*[col(c) for c in docs.columns])


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, fingerprint as 16 hex digits, component_id."""
    found = near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))
