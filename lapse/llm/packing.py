"""Packing token sequences: first-fit decreasing by a tournament tree, in randomised groups of documents.

1. One pass tokenizes every text, appends the end id, cuts the ids into pieces of at most
   ``CAPACITY``, and keeps of each piece only its checksum.
2. Documents are dealt into groups of about ``GROUP_DOCS`` by a hash; each group is packed on its
   own.  Pieces go, longest first, into the first sequence with room; a tournament tree over the
   room that is left finds it in O(log n).

Sequences are numbered ``group * 2**32 + number in group``.  A document longer than the capacity
gives full sequences and one remainder, so only remainders are packed together.

Results for odd input: null and empty texts are one piece that holds only the end id; repeated
rows are packed as separate documents; an empty table gives an empty result; extra columns are
ignored; null ids are packed like any other.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.bpe_codec import _map_ids

CAPACITY, GROUP_DOCS, END_ID = 1024, 4096, 0


def first_fit_decreasing(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every size.  Sizes must be 1 to ``capacity``; ties keep their order."""
    order = np.argsort(-sizes, kind="stable")
    leaves = 1 << max(0, (len(sizes) - 1).bit_length())
    room = [capacity] * (2 * leaves)  # node i holds the most room among the leaves below it
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return bins, offsets


def tokenized_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     vocab_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(id, doc_tokens, crcs): per document its ids with the end id, and the checksum of each piece."""
    def rows(vocab, ids, starts):
        import zlib

        import pyarrow as pa
        size = np.diff(starts) + 1
        raw, end = memoryview(np.ascontiguousarray(ids, dtype="<i4").view(np.uint8)), END_ID.to_bytes(4, "little")
        crcs = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            own = [zlib.crc32(raw[4 * p:4 * min(p + capacity, b)]) for p in range(a, b + 1, capacity)]
            own[-1] = zlib.crc32(end, own[-1])
            crcs.append(own)
        return {"doc_tokens": pa.array(size, type=pa.int64()), "crcs": pa.array(crcs, type=pa.list_(pa.int64()))}
    return _map_ids(docs, id_col, text_col, vocab_path, "doc_tokens long, crcs array<long>", rows)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab_path: str | None = None,
         capacity: int = CAPACITY, group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    groups = max(1, math.ceil(docs.count() / group_docs))
    pieces = tokenized_pieces(docs, id_col, text_col, vocab_path, capacity)
    # The task's number spreads rows that repeat an id and a text.
    deal = F.pmod(F.xxhash64(F.col(f"`{id_col}`"), "doc_tokens", "crcs", F.spark_partition_id()), F.lit(groups)).alias("group")
    dealt = pieces.select(F.col(f"`{id_col}`").alias("id"), "doc_tokens", "crcs", deal)
    id_type = dealt.schema["id"].dataType.simpleString()

    def run(key, table):
        import pyarrow as pa
        import pyarrow.compute as pc
        table = table.sort_by([("id", "ascending"), ("doc_tokens", "ascending")]).combine_chunks()
        crcs = table.column("crcs").combine_chunks()
        parent = crcs.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(parent)), parent)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(parent) - parent, parent)) * capacity
        tokens = table.column("doc_tokens").to_numpy()
        length = np.minimum(capacity, tokens[row] - start)
        bins, offset = first_fit_decreasing(length, capacity)
        return pa.table({"id": pc.take(table.column("id"), pa.array(row)), "start": start, "length": length,
                         "ids_crc32": crcs.flatten(), "doc_tokens": tokens[row],
                         "sequence_id": (key[0].as_py() << 32) + bins, "offset": offset})

    packed = dealt.groupBy("group").applyInArrow(
        run, f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return packed.withColumnRenamed("id", id_col)


def packing(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """The pieces of ``documents`` with doc_id, packed with production parameters."""
    return pack(docs, vocab_path=vocab_path)
