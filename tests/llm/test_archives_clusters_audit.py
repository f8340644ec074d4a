"""WARC archives, centroid clustering and the source audit against brute force, and on odd input."""

import base64
import gzip
import hashlib
import math
import random

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from lapse.llm import centroid_clustering as cc
from lapse.llm import source_audit as sa
from lapse.llm import warc
from lapse.llm.oracle import SQL
from tools.oracle_check import canon

MARK, END = warc.MARK.encode(), warc.END.encode()


def cut(payload: bytes, size: int) -> list[bytes]:
    out, at = [], 0
    while True:
        end = warc.chunk_end(payload, at, size)
        out.append(payload[at:end])
        if end == len(payload):
            return out
        at = end


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["\r", "\n", "\r\n", END.decode(), "WARC/1.1", MARK.decode(), "WARC", "/1.1\r\n", "x", "é", "日", "🙂"]), max_size=20),
       st.integers(4, 40))
def test_chunks_never_hold_a_record_mark(pieces, size):
    payload = "".join(pieces).encode()
    chunks = cut(payload, size)
    assert b"".join(chunks) == payload
    for chunk in chunks:
        chunk.decode()
        assert len(chunk) <= size
        assert (END + chunk + MARK).find(MARK) == len(END) + len(chunk)


PAYLOADS = [None, "", "<p>a</p>", "<p>a</p>", MARK.decode() * 3, "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "\r\n\r\n", "\r\n\r\nWARC/1.1",
            "é日🙂" * 60, "x" * 700, "x" * 700, "<p>a</p>", "﻿bom", "tail\r\n", "\x00\x1f", "x" * 200_000]


def pages_frame(spark):
    rows = [(i, f"http://e/{i}" if i % 3 else "bad url\r\nX: y", p, "c") for i, p in enumerate(PAYLOADS)]
    rows += [(2, "http://again", "<p>a</p>", "c"), (None, None, "<p>a</p>", "c"), (None, None, "only null id", "c"), (None, None, "only null id", "c")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, record string").withColumn("chunk", F_lit(1)).repartition(3).checkpoint()


def F_lit(x):
    from pyspark.sql import functions as F
    return F.lit(x)


def expected_records(rows):
    groups = {}
    for i, p in rows:
        groups.setdefault((p or "").encode(), []).append(i)
    out = []
    for payload, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out += [(i, len(payload), digest, "revisit" if k else "response", ids[0] if k else None) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def test_archives_read_back_as_written(spark, tmp_path):
    pages = pages_frame(spark)
    rows = [(r["page_id"], r["html"]) for r in pages.collect()]
    for size in (16, warc.CHUNK_BYTES):
        path = str(tmp_path / f"a{size}")
        got = warc.warc_round_trip(pages, path, chunk_bytes=size)
        assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        assert sorted(map(tuple, got.collect()), key=str) == expected_records(rows)
        stored = {}
        for r in warc.read_payload_chunks(spark, path).collect():
            assert len(r["data"]) <= size
            stored.setdefault(r["page"], []).append((r["segment"], bytes(r["data"])))
        payloads = {i: b"".join(d for _, d in sorted(parts)) for i, parts in stored.items() if i is not None}
        first = {str(i): (p or "").encode() for i, p in rows}
        assert all(payloads[i] == first[i] for i in payloads)
        assert len(payloads) == sum(1 for i, *_, kind, _ in expected_records(rows) if kind == "response" and i is not None)


def test_archives_are_plain_warc(spark, tmp_path):
    warc.write_archives(pages_frame(spark), str(tmp_path / "w"), chunk_bytes=64)
    n = 0
    for file in (tmp_path / "w").glob("*.gz"):
        raw = gzip.open(file).read()
        while raw:
            assert raw.startswith(b"WARC/1.1\r\n")
            head, raw = raw.split(END, 1)
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            assert raw[size:size + 4] == END
            assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI"} <= set(fields) and " " not in fields["WARC-Target-URI"]
            raw, n = raw[size + 4:], n + 1
    assert n > len(PAYLOADS)


def test_damaged_archive_raises(spark, tmp_path):
    import pytest
    path = tmp_path / "d"
    path.mkdir()
    warc.write_archives(spark.createDataFrame([(1, "abc")], "page_id long, html string"), str(tmp_path / "ok"))
    raw = b"".join(gzip.open(f).read() for f in (tmp_path / "ok").glob("*.gz"))
    (path / "x.txt").write_bytes(raw.replace(b"abc", b"abd"))
    with pytest.raises(Exception, match="does not have the payload"):
        warc.read_archives(spark, str(path)).collect()


def test_least_bytes_and_empty_pages(spark):
    pages = spark.createDataFrame([(3, "ab"), (1, "ab"), (2, "abcd"), (5, "abcd")], "page_id long, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.warc_round_trip(pages, least_bytes=3).collect()}
    assert got == {1: ("response", None), 3: ("response", None), 2: ("response", None), 5: ("revisit", 2)}
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


# -- clustering --------------------------------------------------------------------------------------------------

def brute_clusters(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for c in range(len(centroids)):
            members = [v for (_, v), a in zip(kept, own) if a == c]
            if members:
                centroids[c] = [sum(col) // len(members) for col in zip(*members)]
    own = assign()
    dist = [far(v, centroids[a]) for (_, v), a in zip(kept, own)]
    return sorted(((i, a, d, sum(x for x, b in zip(dist, own) if b == a), sum(dist), hashlib.sha256(",".join(map(str, centroids[a])).encode()).hexdigest())
                   for (i, _), a, d in zip(kept, own, dist)), key=str)


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, v string")


def test_clusters_match_brute_force(spark):
    pick = random.Random(5)
    centres = [[pick.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [c + pick.gauss(0, 0.4) for c in centres[i % 5]]) for i in range(300)]
    rows += [(i + 300, rows[0][1]) for i in range(40)] + [(7, rows[9][1]), (None, rows[4][1]), (900, [0.0] * 64), (901, [1e5] + [0.0] * 63)]
    rows += [(902, None), (903, []), (904, [0.5] * 63), (905, [None] + [0.1] * 63), (906, [math.nan] + [0.1] * 63), (907, [math.inf] + [0.1] * 63)]
    got = cc.centroid_clustering(vectors_frame(spark, rows).repartition(3).checkpoint())
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(rows)


def test_large_components_and_few_vectors(spark):
    rows = [(1, [3e5] * 64), (2, [3e5 + 7.25] * 64), (3, [-1.0] * 64)]
    got = cc.centroid_clustering(vectors_frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(rows)
    rows = [(i, [2e6 + i % 3] + [float(i)] * 63) for i in range(20)]
    got = cc.centroid_clustering(vectors_frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(rows)
    assert cc.centroid_clustering(vectors_frame(spark, rows).limit(0)).count() == 0


def test_partitions_of_many_blocks(spark):
    """Blocks and states stay side by side where Spark hands a partition over in batches of unequally many rows."""
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(6)
    n = 64 * cc.BLOCK_ROWS
    vectors = (rng.normal(size=(8, 64))[rng.integers(0, 8, n)] + rng.normal(size=(n, 64)) / 2).round(3)
    table = pa.table({"vec_id": np.arange(n), "embedding": pa.ListArray.from_arrays(np.arange(0, 64 * n + 1, 64, dtype="i4"), vectors.ravel())})
    whole = np.floor(vectors * 1024).astype(np.int64)
    first = sorted(range(n), key=lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest())[:8]
    centroids = whole[first]
    for i in range(11):
        far = np.stack([((whole - c) ** 2).sum(axis=1) for c in centroids], axis=1)
        own = far.argmin(axis=1)
        if i < 10:
            centroids = np.stack([whole[own == c].sum(axis=0) // (own == c).sum() if (own == c).any() else centroids[c] for c in range(8)])
    got = cc.centroid_clustering(spark.createDataFrame(table).coalesce(1).checkpoint()).toPandas().sort_values("vec_id")
    assert got["vec_id"].tolist() == list(range(n))
    assert got["cluster"].tolist() == own.tolist()
    assert got["distance"].tolist() == far[np.arange(n), own].tolist()
    assert set(got["centroid_sha256"]) == {hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest() for c in set(own.tolist())}


def test_heaps_pop_only_expired_vectors():
    import numpy as np
    rng = np.random.default_rng(1)
    part = np.concatenate([rng.integers(-50, 50, (200, 64)) + shift for shift in (0, 2000, -2000)])
    centroids = [part[0].tolist(), part[200].tolist(), part[400].tolist()]
    block = cc.BlockState(len(part), 3, None)
    block.rescan(list(range(len(part))), cc._distances(part, centroids), [0.0] * 3)
    again = cc.BlockState(len(part), 3, block.raw())
    assert again.expired([10.0] * 3) == []
    keys = sorted(key for heap in again.heaps for key, _ in heap)
    near = again.expired([keys[len(keys) // 2]] * 3)  # half of the gaps are used up
    assert len(part) / 2 <= len(near) < len(part) * 0.6
    assert sum(map(len, again.heaps)) == len(part) - len(near)


# -- source audit ------------------------------------------------------------------------------------------------

def test_audit_of_odd_documents(spark):
    pick = random.Random(2)
    words = ["Alpha", "beta", "GAMMA", "délta", "日本", "ÉTÉ", "x1y", "it's", "zz", "omega"]
    rows = [(pick.choice(["en", None, "fr", ""]), pick.choice(["a", "b", "c", None]), " ".join(pick.choices(words, k=pick.randint(0, 30)))) for _ in range(160)]
    rows += [("de", "s1", "alone here"), ("de", "s2", None), ("it", "only", "one two"), ("en", "empty", ""), ("fr", "long", "beta " * 20_000)]
    rows += [rows[0]] * 15
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "lang string, source string, text string, n long, term string").repartition(4).checkpoint()
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = canon(con.execute(SQL["op13_source_audit"]).fetchdf())
    got = sa.source_audit(docs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert canon(got.toPandas()) == want
    assert sa.source_audit(docs.limit(0)).count() == 0
