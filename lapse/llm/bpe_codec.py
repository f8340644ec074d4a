"""BPE encoding and decoding of whole texts (method: see ``lapse.llm.bytebpe``).

Every Python task gathers about ``TASK_CHARS`` characters, maps every pair of symbols in them to
its positions, merges rank by rank, and gives each text its ids.  No shuffle; a task holds one
group of texts at a time.  The tokenizer file is read on the driver (its size is fixed) and sent
along, so executors need no copy of it.

Results for odd input: null and empty texts have no ids and decode to the empty text; texts of
any length are encoded whole (one longer than a group is a group of its own); repeated rows give
repeated results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.bytebpe import Encoder, vocabulary
from lapse.llm.common import col, gathered, in_tasks, text_batches, text_or_empty


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def read_vocabulary(path: str | None = None) -> bytes:
    return Path(path or default_vocabulary()).read_bytes()


def _source(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    source = docs.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return source, source.schema["id"].dataType.simpleString()


def _map_ids(docs: DataFrame, id_col: str, text_col: str, vocab_path: str | None, schema: str, rows) -> DataFrame:
    """Apply ``rows(vocab, ids, starts) -> columns`` to every group of texts; ``id`` comes first."""
    source, id_type = _source(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocab_path))

    def run(batches):
        import pyarrow as pa
        vocab = vocabulary(sent.value)
        encode = Encoder(vocab)
        for group, texts in text_batches(batches):
            ids, starts = encode(texts)
            columns = rows(vocab, ids, starts)
            del ids, texts
            yield pa.RecordBatch.from_arrays([gathered(group, "id"), *columns.values()], names=["id", *columns])
            del group, columns

    return in_tasks(source, run, f"id {id_type}, {schema}").withColumnRenamed("id", id_col)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab_path: str | None = None) -> DataFrame:
    """(id, ids): the token ids of every text."""
    def rows(vocab, ids, starts):
        import pyarrow as pa
        return {"ids": pa.ListArray.from_arrays(pa.array(starts.astype("i4")), pa.array(ids))}
    return _map_ids(docs, id_col, text_col, vocab_path, "ids array<int>", rows)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocab_path: str | None = None) -> DataFrame:
    """(id, text): the text that the ids stand for, special tokens included.  Null ids decode to the empty text."""
    source = encoded.select(col(id_col).alias("id"), col(ids_col).cast("array<int>").alias("ids"))
    sent = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocab_path))

    def run(batches):
        import pyarrow as pa
        table = vocabulary(sent.value).bytes
        for batch in batches:
            texts = [_spell(table, ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, type=pa.string())], names=["id", "text"])

    return in_tasks(source, run, f"id {source.schema['id'].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)


def _spell(table: list[bytes], ids: list[int]) -> str:
    return b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")


def bpe_codec(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """Digest: number of ids, and hashes of the ids and of the text decoded from them."""
    def rows(vocab, ids, starts):
        import pyarrow as pa
        sizes, in_ids, in_text = [], [], []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            own = ids[a:b]
            sizes.append(b - a)
            in_ids.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
            in_text.append(hashlib.sha256(_spell(vocab.bytes, own.tolist()).encode()).hexdigest())
        return {"n_tokens": pa.array(sizes, type=pa.int64()), "ids_sha256": pa.array(in_ids, type=pa.string()),
                "decoded_sha256": pa.array(in_text, type=pa.string())}
    return _map_ids(docs, "doc_id", "text", vocab_path, "n_tokens long, ids_sha256 string, decoded_sha256 string", rows)
