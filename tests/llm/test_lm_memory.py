"""Language model: what a task holds at once, and the same numbers however texts are parted."""

import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyspark

from lapse.llm import nce_lm as M
from lapse.llm.common import text_batches
from tests.llm.conftest import ODD, WORDS, prose


def model(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    counts = M.word_counts(docs).checkpoint()
    return docs, counts, M.lexicon(counts, len(texts))


def as_batches(texts, rows):
    return [pa.RecordBatch.from_arrays([pa.array(range(i, min(i + rows, len(texts)))), pa.array(texts[i:i + rows], type=pa.string())], names=["id", "text"])
            for i in range(0, len(texts), rows)]


def test_scoring_holds_a_part_of_a_batch_at_once(spark, monkeypatch):
    pick = random.Random(5)
    known = [f"{w}-{i}" for w in WORDS for i in range(100)]
    docs, counts, lex = model(spark, [" ".join(known)])
    caught, real = [], M.in_tasks
    monkeypatch.setattr(M, "in_tasks", lambda df, run, schema: caught.append(run) or real(df, run, schema))
    M.score(docs, counts, lex, M.Params.start(lex))
    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [" ".join(pick.choices(known, k=4000)) for _ in range(350)]  # 12 million characters
    assert sum(map(len, texts)) > 11_000_000
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in caught[0](as_batches(texts, 100)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == len(texts) and peak < 120e6


def test_training_groups_are_the_same_however_texts_are_parted(spark, monkeypatch):
    texts = [t or "" for t in ODD] + [prose(n, n) for n in range(1, 60)]
    _, _, lex = model(spark, texts)
    for group, part in ((900, 100), (5000, 1200), (1, 1), (10**9, 700)):
        monkeypatch.setattr(M, "BATCH_CHARS", group)
        monkeypatch.setattr(M, "PART_CHARS", part)
        want = [M.read(some, lex) for _, some in text_batches(as_batches(texts, 7), limit=group)]
        got = list(M.class_groups(as_batches(texts, 7), lex))
        assert len(got) == len(want)
        for arrays, r in zip(got, want):
            assert all(np.array_equal(a, b) for a, b in zip(arrays, (r.target, r.before, r.earlier)))
    assert list(M.class_groups([], lex)) == []


def test_normalising_sums_are_kept_from_part_to_part(spark):
    texts = [t or "" for t in ODD] + [prose(n, n) for n in range(1, 60)]
    docs, _, lex = model(spark, texts)
    params = M.train(docs, lex)
    whole = M.class_logs(M.read(texts, lex), params)
    sums = np.full(M.CLASSES**2, np.nan)
    parts = [M.class_logs(M.read([t], lex), params, sums) for t in texts]
    assert np.allclose(np.concatenate(parts), whole, rtol=0, atol=1e-5)
