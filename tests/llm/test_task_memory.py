"""Memory of the tasks that tokenize: what they hold at once, and what they leave behind."""

import gc
import tracemalloc
import zlib

import numpy as np
import pytest

from lapse.llm import bytebpe as B
from lapse.llm import packing as P
from lapse.llm.bpe_codec import read_vocabulary


@pytest.fixture(scope="module")
def vocab():
    return B.vocabulary(read_vocabulary())


def test_encoder_leaves_no_garbage(vocab):
    encode, texts = B.Encoder(vocab), ["two words, and  more\n" * 5, "", "</s> it's 12"]
    encode(texts)
    gc.collect()
    gc.disable()
    try:
        encode(texts)
        assert gc.collect() == 0
    finally:
        gc.enable()


def test_spread_needs_little_beside_its_result():
    values, n = np.arange(64, dtype=np.int32), 60_000
    at, order = np.array([0, 64]), np.zeros(n, dtype=np.int64)
    tracemalloc.start()
    flat, _ = B.spread(values, at, order)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2 * flat.nbytes


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1 << 18])
def test_spread_and_ranks_in_blocks(vocab, monkeypatch, block):
    monkeypatch.setattr(B, "BLOCK", block)
    rng = np.random.default_rng(5)
    at = np.concatenate(([0], np.cumsum([0, 3, 1, 0, 12, 2, 0])))
    values = rng.integers(0, 99, at[-1]).astype(np.int32)
    for order in (rng.integers(0, 7, 40), np.array([0, 3, 6]), np.array([], dtype=np.int64)):
        flat, starts = B.spread(values, at, order)
        parts = [values[at[i]:at[i + 1]] for i in order]
        assert flat.tolist() == [x for p in parts for x in p.tolist()] and flat.dtype == values.dtype
        assert starts.tolist() == [0, *np.cumsum([len(p) for p in parts]).tolist()]
    pairs = vocab.merges[:20]
    assert vocab.ranks(pairs[:, 0], pairs[:, 1]).tolist() == list(range(20))
    assert vocab.ranks(pairs[:0, 0], pairs[:0, 1]).tolist() == []


def test_piece_checksums_at_the_capacity(spark, vocab):
    encode, texts = B.Encoder(vocab), ["", "a", "a b", "a b c", "a b c d", "a b c d e f g"]
    ids, starts = encode(texts)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.doc_tokens, r.crcs) for r in P.tokenized_pieces(rows, capacity=4).collect()}
    for i in range(len(texts)):
        own = [*ids[starts[i]:starts[i + 1]].tolist(), P.END_ID]
        want = [zlib.crc32(np.array(own[k:k + 4], dtype="<u4").tobytes()) for k in range(0, len(own), 4)]
        assert got[i] == (len(own), want)
