"""Chat formatting, nearest neighbours and the pipeline."""

import hashlib

import numpy as np
import pytest

from tests.conftest import SF001


@pytest.mark.parametrize("stretch", [2, 256])
def test_chat_round_trip(spark, stretch):
    from lapse.llm import chat_format as C
    odd = [(10**6, 0, "user", "a\\b \\| [\\|INST] [INST"), (10**6, 1, "tool[", "x[/TURN][SAYS]"), (10**6, 2, None, None), (10**6, 3, "assistant", "<"),
           (10**6, 4, "assistant", "/s>"), (None, 0, "user", ""), (7**8, None, "user", "twice"), (7**8, None, "user", "twice")]
    turns = spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = turns.union(spark.createDataFrame(odd, "conv_id long, turn long, role string, text string")).withColumn("n_turns", turns["role"])
    got = {r.conv_id: r for r in C.read_back(C.format_chats(turns, stretch=stretch)).collect()}
    by = {}
    for r in turns.collect():
        by.setdefault(r.conv_id, []).append((-1 if r.turn is None else r.turn, r.role or "", r.text or ""))
    assert set(got) == set(by)
    for key, want in by.items():
        assert [(t.role, t.text) for t in got[key].turns] == [x[1:] for x in sorted(want)]
        assert got[key].formatted == "".join(s.text for s in got[key].segments)
    assert not got[10**6].valid


def test_chat_digest_and_empty(spark):
    from lapse.llm.chat_format import chat_format
    turns = spark.read.parquet(f"{SF001}/conversations.parquet")
    r = chat_format(turns.limit(0)).collect()
    both = "</s>[INST] ok [/INST]"
    assert len(r) == 1 and r[0].conv_id == -1 and r[0].loss_chars == len(both)
    assert r[0].loss_sha256 == hashlib.sha256(both.encode()).hexdigest()
    assert r[0].turns_sha256 == hashlib.sha256(f"user\n{both}\nassistant\n{both}\n".encode()).hexdigest()
    assert chat_format(turns).where("not valid").count() == 0


def test_template_is_checked():
    from lapse.llm.chat_format import Role, Template
    with pytest.raises(ValueError):
        Template({"user": Role("[U]", "[U]x")}, {})


def test_neighbours(spark):
    from lapse.llm.nn_descent import ann_search
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(600, 16)) * rng.uniform(0.5, 2, (600, 1))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)] + [(1000 + i, vectors[5].tolist(), 1) for i in range(60)]
    bad = [(2000, None, 1), (2020, [0.0] * 16, 1), (2040, [float("nan")] * 16, 1), (2060, [1.0, 2.0], 1), (2080, [None] * 16, 1), (None, vectors[0].tolist(), 1)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, node int")
    got = {}
    for r in ann_search(table).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ids, all_ = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        s = all_ @ all_[np.flatnonzero(ids == q)[0]]
        best = [i for i in np.lexsort((ids, -np.round(s, 9))) if ids[i] != q][:20]
        hits += len({x[1] for x in found} & set(ids[best].tolist()))
        assert [x[0] for x in sorted(found)] == list(range(1, 21)) and q not in [x[1] for x in found]
    assert hits >= 0.9 * 20 * len(got)
    assert ann_search(table.limit(0)).count() == 0
    few = ann_search(spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>, node int")).collect()
    assert [(r.query_id, r.rank) for r in sorted(few)] == [(0, 1), (0, 2)]


def test_neighbours_of_copies_and_lone_vectors(spark):
    from lapse.llm.nn_descent import ann_search, exact_others
    schema = "vec_id long, embedding array<double>"
    for n in (7, 50):  # one distinct vector
        got = ann_search(spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(n)], schema)).collect()
        for q in range(0, n, 20):
            assert sorted(r.rank for r in got if r.query_id == q) == list(range(1, min(20, n - 1) + 1))
    rng = np.random.default_rng(1)
    v = rng.normal(size=16)
    near = [v + 1e-3 * rng.normal(size=16) for _ in range(400)]
    lone = [(1000 + i, (-v).tolist()) for i in range(3)]  # alone in its leaf in every tree
    table = spark.createDataFrame([(1 + i, x.tolist()) for i, x in enumerate(near)] + lone, schema)
    got = ann_search(table).where("query_id = 1000").collect()
    assert sorted(r.rank for r in got) == list(range(1, 21)) and {1001, 1002} <= {r.vec_id for r in got}
    nodes = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(near)], "node long, v array<double>")
    s = np.array(near) @ near[3]
    best = {r.other for r in exact_others(nodes, nodes.where("node = 3").select("node")).collect()}
    assert best == set(np.argsort(-s)[:21].tolist())


def test_pipeline(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, docs, SF001)
        assert after.columns == docs.columns and after.schema == docs.schema
        after = after.checkpoint()
        assert 0 < after.count() <= docs.count()
        docs = after
    rows = P.run(spark, SF001)
    assert {r.doc_id for r in rows.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        empty_after = stage(spark, empty, SF001)
        assert empty_after.count() == 0


def test_registered_queries_cover_every_operator():
    import __spark_entry__ as E
    names = E.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def nearest_exactly(rows, query, top=20):
    """Brute force over row positions: a row's own position alone is left out."""
    vectors = np.array([v for _, v in rows])
    out = []
    for i, (q, v) in enumerate(rows):
        if query(q):
            s = vectors @ np.array(v)
            best = sorted((k for k in range(len(rows)) if k != i), key=lambda k: (-s[k], rows[k][0]))[:top]
            out.append((q, [(rows[k][0], s[k]) for k in best]))
    return out


def test_neighbours_among_many_near_copies(spark):
    """Copies that differ by less than the graph's bytes show: each query gets its true neighbours."""
    from lapse.llm.nn_descent import ann_search
    rng = np.random.default_rng(3)
    centre = rng.normal(size=24) / 5
    rows = [(i, x.tolist()) for i, x in enumerate([*(rng.normal(size=(200, 24)) / 5), *(centre + 1e-5 * rng.normal(size=(400, 24)))])]
    got = {}
    for r in ann_search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    shares = []
    for q, best in nearest_exactly(rows, lambda i: i % 20 == 0):
        shares.append(sum(score >= best[-1][1] - 1e-12 for score in got[q].values()) / len(best))
    assert np.mean(shares) >= 0.9 and min(shares) >= 0.8


def test_an_id_with_two_vectors_is_two_queries(spark):
    from lapse.llm.nn_descent import ann_search
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(120)] + [(0, rng.normal(size=12).tolist()), (20, None)]
    rows[-1] = (20, rows[20][1])  # a repeated row
    got = sorted(((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in ann_search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    want = sorted((q, k + 1, i, round(s, 9)) for q, best in nearest_exactly(rows, lambda i: i % 20 == 0) for k, (i, s) in enumerate(best))
    assert got == want
