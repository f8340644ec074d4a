"""Tasks of the neighbour graph work on flat arrays: the same rows as entry by entry, in less time, however batches are cut."""

import time

import numpy as np
import pyarrow as pa
import pytest

from lapse.llm import nn_descent as N

SCHEMA = pa.schema([("node", pa.int64()), ("kind", pa.int32()), ("vec", pa.binary()), ("ids", pa.list_(pa.int64())), ("sims", pa.list_(pa.float32())),
                    ("fresh", pa.list_(pa.bool_())), ("vecs", pa.list_(pa.binary()))])


class Rows:
    """Stands for a table: what a stage asks of it gives it back."""

    def __getattr__(self, name):
        return lambda *a, **k: self


@pytest.fixture()
def task(spark, monkeypatch):
    """What a stage runs in its tasks."""
    monkeypatch.setattr(N, "in_tasks", lambda df, run, schema: run)
    return lambda stage, tables=1: stage(*[Rows()] * tables)


def as_batches(rows, size):
    return [pa.RecordBatch.from_pylist(rows[i:i + size], schema=SCHEMA) for i in range(0, len(rows), size)]


def made(n, offers, seed=1):
    """Own rows and offers sorted by node: neighbours named twice, the node itself, an offer to a node that is not there."""
    rng = np.random.default_rng(seed)
    vecs = [N.pack_vector(x) for x in rng.normal(size=(3 * n, 17))]
    sim = rng.normal(size=(n, 3 * n)).astype(np.float32)
    rows = []
    for node in range(n):
        for kind in [0] * (node != 2) + [1] * offers:
            ids = rng.permutation(3 * n)[:rng.integers(0, 13)].tolist()
            if kind == 0:
                ids = sorted(rng.permutation(3 * n)[:N.DEGREE * (node % 3) // 2].tolist(), key=lambda i: -sim[node, i])
            rows.append({"node": node, "kind": kind, "vec": None if kind else vecs[node], "ids": ids, "sims": [float(sim[node, i]) for i in ids],
                         "fresh": [bool(kind)] * len(ids), "vecs": [vecs[i] for i in ids]})
    return rows


def merged_by_entry(batches):
    groups = {}
    for batch in batches:
        for r in batch.to_pylist():
            groups.setdefault(r["node"], []).append(r)
    for node, group in groups.items():
        if group[0]["kind"] == 0:
            best = {}
            for r in group:
                for x in zip(r["ids"], r["sims"], r["fresh"], r["vecs"]):
                    if x[0] != node:
                        best.setdefault(x[0], x)
            kept = sorted(best.values(), key=lambda x: (-x[1], x[0]))[:N.DEGREE]
            yield group[0] | {c: [x[i] for x in kept] for i, c in enumerate(("ids", "sims", "fresh", "vecs"))}


@pytest.mark.parametrize("size", [1, 3, 50, 10_000])
def test_merged_lists(task, size):
    rows = made(40, 9)
    got = [r for b in task(N.merged)(as_batches(rows, size)) for r in b.to_pylist()]
    assert got == list(merged_by_entry(as_batches(rows, size)))
    assert list(task(N.merged)([])) == []
    lone = [r for b in task(N.merged)(as_batches([rows[0] | {c: [] for c in ("ids", "sims", "fresh", "vecs")}], 1)) for r in b.to_pylist()]
    assert lone[0]["ids"] == [] and lone[0]["vec"] == rows[0]["vec"]


def test_merging_takes_less_than_entry_by_entry(task):
    batches = as_batches(made(400, 25), 10_000)
    began = time.process_time()
    want = [r["ids"] for r in merged_by_entry(batches)]
    middle = time.process_time()
    found = list(task(N.merged)(batches))
    assert (time.process_time() - middle) * 2 < middle - began
    assert [ids for b in found for ids in b.column("ids").to_pylist()] == want


@pytest.mark.parametrize("size", [4, 1000])
def test_joined_members(task, size):
    """Every offer is a pair of members, one of them new, unknown to its node and over its floor; none is missing."""
    rng = np.random.default_rng(3)
    n = 60
    vecs = [N.pack_vector(x) for x in rng.normal(size=(n, 17))]
    v = N.unpack(vecs)
    rows = []
    for node in range(n):
        ids = rng.permutation([i for i in range(n) if i != node])[:N.DEGREE if node % 2 else 5]
        ids = ids[np.argsort(-(v[ids] @ v[node]))].tolist()
        rows.append({"node": node, "kind": 0, "vec": vecs[node], "ids": ids, "sims": [float(v[i] @ v[node]) + 1e-3 for i in ids],  # no score at a floor
                     "fresh": rng.integers(0, 2, len(ids)).astype(bool).tolist(), "vecs": [vecs[i] for i in ids]})
    own = {r["node"]: r for r in rows}
    reverse = [r for b in task(N.handed)(as_batches(rows, size)) for r in b.to_pylist()]
    sampled = {}
    for r in reverse:
        u, (back,) = r["node"], r["ids"]
        assert u in own[back]["ids"] and r["vecs"] == [vecs[back]] and r["fresh"] == [own[back]["fresh"][own[back]["ids"].index(u)]]
        assert r["sims"] == [pytest.approx(own[back]["sims"][-1])] if len(own[back]["ids"]) == N.DEGREE else [-np.inf]
        sampled.setdefault(back, []).append((u, r["fresh"][0]))
    for node, r in own.items():
        for fresh in (True, False):
            assert sum(f == fresh for _, f in sampled[node]) == min(N.SAMPLE, r["fresh"].count(fresh))
    together = sorted(rows + reverse, key=lambda r: (r["node"], r["kind"]))
    out = [r for b in task(N.joined, 2)(as_batches(together, size)) for r in b.to_pylist()]
    for r in out:
        if r["kind"] == 0:
            new = [i for i, f in sampled[r["node"]] if f]
            assert r["fresh"] == [f and i not in new for i, f in zip(r["ids"], own[r["node"]]["fresh"])]
    want = {}
    for u in range(n):
        members, taken = {u: (False, True)}, [0, 0]
        for r in (r for r in together if r["node"] == u and r["kind"]):
            if taken[r["fresh"][0]] < 2 * N.SAMPLE:
                taken[r["fresh"][0]] += 1
                members[r["ids"][0]] = (r["fresh"][0], True)
        for i, fresh in sampled[u]:
            members.setdefault(i, (fresh, False))
        for a, (new, asks) in members.items():
            floor = own[a]["sims"][-1] if len(own[a]["ids"]) == N.DEGREE else -np.inf
            pairs = [(b, float(v[a] @ v[b])) for b, (other, _) in members.items() if b not in (a, u) and (b not in own[u]["ids"] if a == u else new or other)]
            pairs = sorted((x for x in pairs if x[1] > floor), key=lambda x: -x[1])[:N.SAMPLE]
            if asks and pairs:
                want.setdefault(a, []).append(sorted(b for b, _ in pairs))
    offered = {}
    for r in out:
        if r["kind"]:
            assert all(r["fresh"]) and r["vecs"] == [vecs[i] for i in r["ids"]]
            assert np.allclose(r["sims"], v[r["ids"]] @ v[r["node"]], atol=1e-4)
            offered.setdefault(r["node"], []).append(sorted(r["ids"]))
    assert {k: sorted(x) for k, x in offered.items()} == {k: sorted(x) for k, x in want.items()}
