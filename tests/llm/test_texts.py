"""Operators on texts against brute force, over odd documents and over sf 0.001."""

import collections
import hashlib
import json
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    from lapse.llm.bpe_codec import default_vocabulary
    return Tokenizer.from_file(default_vocabulary())


@pytest.fixture(scope="module", params=["odd", "sf"])
def docs(request, spark, odd_docs):
    return odd_docs if request.param == "odd" else spark.read.parquet(f"{SF001}/documents.parquet").limit(120).checkpoint()


def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def rows(df):
    return sorted(map(repr, df.collect()))


def same(got, expected):
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_codec(docs, library):
    from lapse.llm.bpe_codec import bpe_codec, decode, encode
    want = []
    for i, t in texts(docs):
        ids = library.encode(t, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    same([tuple(r) for r in bpe_codec(docs).collect()], want)
    same([tuple(r) for r in decode(encode(docs)).collect()], texts(docs))


def test_token_counts(docs, library):
    from lapse.llm.token_counts import token_counts
    want = [(i, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 512) for i, t in texts(docs)]
    same([tuple(r) for r in token_counts(docs).collect()], want)


def test_counter_machine_forgets_and_random_text_agrees(library):
    import random

    from lapse.llm.bpe_codec import read_vocabulary
    from lapse.llm.bytebpe import Encoder, Vocabulary
    from lapse.llm.token_counts import Counter, TokenCounter
    vocab, pick = Vocabulary(read_vocabulary()), random.Random(3)
    made = ["".join(pick.choice(" \n\t'srelvdtmaA1²é日!.-\xa0\x0b<|>") for _ in range(pick.randint(0, 60))) for _ in range(500)]
    want = [library.encode(t, add_special_tokens=False).ids for t in made]
    ids, at = Encoder(vocab)(made)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
    counter = TokenCounter(vocab)
    counter.counter = Counter(vocab, max_transitions=50)
    assert counter(made).tolist() == [len(w) for w in want]


def test_vocabulary_order_is_checked():
    from lapse.llm.bpe_codec import read_vocabulary
    from lapse.llm.bytebpe import Vocabulary
    spec = json.loads(read_vocabulary())
    spec["model"]["merges"].reverse()
    with pytest.raises(ValueError):
        Vocabulary(json.dumps(spec).encode())


def test_packing(docs, library):
    from lapse.llm.packing import pack
    got = pack(docs, group_docs=16).collect()
    ids = collections.defaultdict(list)
    for i, t in texts(docs):
        ids[i].append(library.encode(t, add_special_tokens=False).ids + [0])
    bins = collections.defaultdict(list)
    for r in got:
        own = [x for x in ids[r.doc_id] if len(x) == r.doc_tokens and zlib.crc32(np.array(x[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32]
        assert own
        bins[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in got) == sum(len(x) for xs in ids.values() for x in xs)
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= 1024


def test_first_fit_decreasing_matches_a_plain_loop():
    from lapse.llm.packing import first_fit_decreasing
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 300):
        sizes = rng.integers(1, 1025, n)
        bins, offsets = first_fit_decreasing(sizes)
        room, want = [], {}
        for i in sorted(range(n), key=lambda i: -sizes[i]):
            b = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
            room += [1024] * (b == len(room))
            want[i] = (b, 1024 - room[b])
            room[b] -= sizes[i]
        assert [(int(b), int(o)) for b, o in zip(bins, offsets)] == [(want[i][0], int(want[i][1])) for i in range(n)]


def quality(t):
    w = WORD.findall(t)
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    twice = {p for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(twice)


def test_quality_rules(docs):
    from lapse.llm.quality_rules import quality_rules
    want = []
    for i, t in texts(docs):
        m = quality(t)
        want.append((i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    got = quality_rules(docs).collect()
    same([tuple(r)[:7] for r in got], want)
    assert not any(r.kept and r.base_failed for r in got)


def test_quality_policies_and_ablations(docs):
    from lapse.llm import quality_rules as Q
    ledger = Q.measure(docs).checkpoint()
    total = ledger.count()
    for r in Q.ablations(ledger, "v2").collect():
        others = [x for x in Q.POLICIES["v2"] if x != r.rule]
        mask = sum(Q._BIT[x] for x in others)
        assert r.n_kept_without == ledger.where(f"(failures & {mask}) = 0").count()
        assert r.n_failed == ledger.where(f"(failures & {Q._BIT[r.rule]}) != 0").count() <= total
    assert Q.keep_clean(docs).columns == docs.columns


def fingerprint(t):
    import xxhash
    w = t.encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash(docs, monkeypatch):
    from lapse.llm import simhash_dedup as S
    monkeypatch.setattr(S, "TILE", 4)  # so that keys with few rows are cut into tiles, too
    every = texts(docs)
    prints = [fingerprint(t) for _, t in every]
    part = list(range(len(every)))
    for i in range(len(every)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = part[i], part[j]
                part = [b if p == a else p for p in part]
    least = {p: min((every[i][0] for i in range(len(every)) if part[i] == p and every[i][0] is not None), default=None) for p in set(part)}
    same([tuple(r) for r in S.simhash_dedup(docs).collect()], [(every[i][0], f"{prints[i]:016x}", least[part[i]]) for i in range(len(every))])
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {x for x in least.values()}


def test_one_row_of_each_group_stays(spark):
    from lapse.llm.simhash_dedup import keep_one
    words = " ".join(f"w{i}" for i in range(400))
    other, third = " ".join(f"v{i}" for i in range(300)), " ".join(f"u{i}" for i in range(300))
    near = words.upper()  # the same fingerprint, another text
    rows = [(1, words, 5)] * 3 + [(1, near, 5), (2, words, 5), (None, words, 5)]
    rows += [(None, other, 6)] * 50 + [(None, other.upper(), 6)] * 2 + [(1, third, 7), (1, third, 8), (9, third, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _kept_id int").repartition(4)
    got = keep_one(docs)
    assert got.schema == docs.schema
    assert sorted((r.doc_id or 0, r.text[0].lower(), r._kept_id // 8) for r in got.collect()) in (
        [(0, "v", 0), (1, "u", k), (1, "w", 0)] for k in (0, 1))
    once = keep_one(docs.dropDuplicates()).count()
    assert once == keep_one(docs.union(docs)).count() == 3


def test_components_of_chains_and_stars(spark):
    from lapse.llm.simhash_dedup import components
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (-5, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[x] == 100 for x in range(101, 160)) and got[200] == -5


def test_links_of_a_dense_group(spark):
    from lapse.llm import simhash_dedup as S
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 1 << 62))
    fps = {centre} | {centre ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(1, 5))) for _ in range(400)}
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in fps]
    edges = S.links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    got = {r.node: r.component for r in S.components(edges).collect()}
    part = {x: x for x in signed}
    for x in signed:
        for y in signed:
            if part[x] != part[y] and ((x ^ y) & ((1 << 64) - 1)).bit_count() <= 3:
                low, high = sorted((part[x], part[y]))
                part = {k: low if v == high else v for k, v in part.items()}
    assert all(got.get(x, x) == p for x, p in part.items())


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    luhn = sum((d * 2 - 9 if d > 4 else d * 2) if k % 2 else d for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in hit.split(".")),
            "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]


def base_spans(t):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, t) if passes(kind, m.group())]
    return sorted(found)


PERSONAL = ["a@b.c_d@e.f x@y a@b@c.d ..foo@d.e a@b.c..foo@d.e tail", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255",
            "4111 1111 1111 1111 4111111111111111 é4111-1111-1111-1111é", "+1 (702) 555-0742 170.106.4.9 +12 ++44 20 7946 0958.",
            "me (at) host (dot) com", "to x@" + ".".join("ab"[i % 2] for i in range(341)) + " and", "y@" + "long-label." * 20_000 + "z!", "1 " * 9000 + "9" * 9000 + " " + "a." * 9000 + "a@b.c", None, ""]


def test_pii(docs, spark):
    from lapse.llm.pii_spans import pii_spans, redact
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(PERSONAL)], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(more)
    want = []
    for i, t in texts(both):
        found = base_spans(t)
        text = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in found)
        want.append((i, *[sum(f[3] == k for f in found) for k in BASE], hashlib.sha256(text.encode()).hexdigest()))
    got = pii_spans(both).collect()
    same([tuple(r)[:6] for r in got], want)
    clean = redact(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    left = [t for _, t in texts(redact(both)) if any(base_spans(t))]
    assert all("[EMAIL]" in t or "[IP]" in t or "[CARD]" in t or "[PHONE]" in t for t in left)


def test_lm_scores(docs):
    from lapse.llm.nce_lm import lm_scores
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    every = [(i, t.encode().lower().split() + [None]) for i, t in texts(docs)]
    c = collections.Counter(w for i, ws in every if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = [(i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 5)) for i, ws in every]
    got = lm_scores(docs).collect()
    same([(*tuple(r)[:5], round(r.base_score, 5)) for r in got], want)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_lm_probabilities_add_up(spark):
    from lapse.llm import nce_lm as M
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("text")
    counts = M.word_counts(docs).checkpoint()
    lex = M.lexicon(counts, docs.count(), frequent=500)
    params = M.train(docs, lex)
    z = params.predicted(np.array([3]), np.array([300])) @ params.outputs.T + params.bias
    r = M.read(["the of"], lex)
    for t in (0, 1, 7, 400):
        r.target[:], r.before[:], r.earlier[:] = t, 3, 300
        assert np.allclose(M.class_logs(r, params)[0], (z[0, t] - np.log(np.exp(z).sum())) / np.log(10), atol=1e-4)
    # Within a bucket: its words' shares and the unknown share.
    for b in range(5):
        own = sum(x.c for x in counts.where(f"bucket = {b}").collect() if bytes(x.word) not in {bytes(w.as_py()) for w in lex.words[:M.SINGLES]})
        assert own == lex.total[b]


def test_classifier_on_held_out_documents(spark):
    from lapse.llm.subword_classifier import keep_good, quality_classifier, train
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    scored = quality_classifier(docs, labels)
    assert scored.count() == docs.count()
    right = scored.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.9
    model = train(docs, labels)
    assert keep_good(docs, model).columns == docs.columns


def test_classifier_odd_input(odd_docs, no_docs, spark):
    from lapse.llm.subword_classifier import keep_good, quality_classifier, train
    labels = spark.createDataFrame([(10, 1, 0), (13, 0, 0), (0, 1, 0), (None, 1, 1), (14, None, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        got = quality_classifier(odd_docs, some).collect()
        assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
        assert keep_good(odd_docs, train(odd_docs, some)).columns == odd_docs.columns
    assert quality_classifier(no_docs, labels).count() == 0


def test_copies_of_a_labelled_id_send_one_bag(spark, monkeypatch):
    """A labelled id that fills the table, and ids labelled both ways."""
    from lapse.llm import subword_classifier as S
    rows = [(1, f"copy {i % 3} of the text") for i in range(3000)] + [(2, "other words"), (3, "b"), (3, "a"), (4, "never")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, 1), (3, 0)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(S, "fit", lambda samples, marks: seen.append((len(samples), marks.tolist())))
    S.train(docs, labels)
    assert seen == [(3, [1, 0, 1])]  # ids 1, 2, 3: an id with both labels counts as label 1


@pytest.mark.parametrize("name", ["bpe_codec", "token_counts", "packing", "quality_rules", "simhash_dedup", "pii_spans", "lm_scores"])
def test_empty_table(no_docs, name):
    from lapse.llm import bpe_codec, nce_lm, packing, pii_spans, quality_rules, simhash_dedup, token_counts
    module = {"lm_scores": nce_lm}.get(name) or locals()[name]
    assert getattr(module, name)(no_docs).collect() == []
