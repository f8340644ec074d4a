"""Source divergence audit: which sources of a language use words unlike the others, by count-cell ranking.

1. One pass over the texts counts every term per (lang, source) and the documents that hold it.  A task counts
   batches of texts with numpy; Spark adds the counts up.
2. A language keeps the terms in at least ``min_docs`` of its documents.  The kept counts are written once.
3. Terms of a group are put into cells by (count in the group, count in the language).  All terms of a cell have
   the same p, q and value, so the value is evaluated once per cell.  Cells of equal value are merged, the merged
   cells are ranked by value, and their multiplicities are added up; only cells that begin before rank ``top`` are
   expanded to their terms, in UTF-8 order.
4. The value of two sources is a sum over cells too.  A term that neither holds adds the same value, a term of
   one source adds a value of that source's cell; so the sums over each source's cells against the other's
   value for an absent term come first, and only terms that both hold are joined, to cells of both counts.

Arithmetic is in integers throughout (decimals of 38 digits where a product may pass a long).

Results for odd input: null text, lang and source are read as ''; a text without terms adds nothing but its group;
texts of any length are counted whole; repeated rows are documents of their own; equal values rank by UTF-8 order
of the item; a language without kept terms gives pairs of value 0 and no terms; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.functions.materialize import freeze, sized_broadcast
from lapse.llm.common import gathered, in_tasks, text_batches, text_or_empty

MIN_DOCS, TOP = 10, 10
SCALE = 1_000_000_000
# Characters of text that a task counts together: smaller than elsewhere, as Spark's own aggregation follows in the
# same task and merges the counts of its batches.
BATCH_CHARS = 4_000_000
# Bytes of no term become spaces, A-Z become a-z, all bytes from 0x80 on stay.
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, n_docs): occurrences of a term in a group, and its documents.

    Every group also has one row with a null term, so groups without terms are seen.
    """
    plain = docs.select(text_or_empty(text_col).alias("text"), text_or_empty(lang_col).alias("lang"),
                        text_or_empty(source_col).alias("source"))
    parts = in_tasks(plain, _count_batches, "lang string, source string, term string, n long, n_docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _count_batches(batches) -> Iterator:
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for rows, texts in text_batches(batches, limit=BATCH_CHARS):
        langs, sources = gathered(rows, "lang").to_pylist(), gathered(rows, "source").to_pylist()
        names: dict = {}
        group = np.array([names.setdefault(pair, len(names)) for pair in zip(langs, sources)], dtype=np.int64)
        joined = [b" ".join(t.encode().translate(TERM_BYTES).split()) for t in texts]
        lists = pc.split_pattern(pa.array(joined, type=pa.large_binary()), b" ")
        coded = lists.flatten().dictionary_encode()
        terms = coded.dictionary
        doc = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
        # Distinct (document, term) pairs with their occurrences, then distinct (group, term) pairs.
        pairs, times = np.unique(doc * len(terms) + coded.indices.to_numpy(), return_counts=True)
        keys = group[pairs // len(terms)] * len(terms) + pairs % len(terms)
        order = np.argsort(keys, kind="stable")
        keys, first, n_docs = np.unique(keys[order], return_index=True, return_counts=True)
        n = np.add.reduceat(times[order], first)
        word = terms.cast(pa.large_string()).cast(pa.string()).take(pa.array(keys % len(terms)))
        real = np.asarray(pc.not_equal(word, "").to_numpy(zero_copy_only=False))  # a text without terms splits into ''
        at, mark = keys // len(terms), len(names)
        pair = list(names)
        of = np.concatenate((at[real], np.arange(mark)))
        yield pa.record_batch({
            "lang": pa.array([p[0] for p in pair], pa.string()).take(pa.array(of)),
            "source": pa.array([p[1] for p in pair], pa.string()).take(pa.array(of)),
            "term": pa.concat_arrays([word.filter(pa.array(real)), pa.nulls(mark, pa.string())]),
            "n": pa.array(np.concatenate((n[real], np.zeros(mark, np.int64)))),
            "n_docs": pa.array(np.concatenate((n_docs[real], np.zeros(mark, np.int64))))})


def kept_counts(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The counts of kept terms with ``n_lang`` (occurrences in the language) and ``first`` (once per language and
    term), and the null-term row of every group.  A window holds one row per source of the language."""
    same = Window.partitionBy("lang", "term")
    seen = counts.select("*", F.sum("n").over(same).alias("n_lang"), F.sum("n_docs").over(same).alias("d_lang"),
                         (F.row_number().over(same.orderBy("source")) == 1).alias("first"))
    return seen.filter(F.col("term").isNull() | (F.col("d_lang") >= min_docs)).select("lang", "source", "term", "n", "n_lang", "first")


def p_sql(count: str, total: str, terms: str) -> str:
    return f"(1 + CAST({SCALE} AS DECIMAL(38, 0)) * ({count} + 2) div nullif({total} + 2 * {terms}, 0))"


def f_sql(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q})))"


def group_totals(kept: DataFrame) -> DataFrame:
    """One row per (lang, source): kept occurrences ``total``, kept terms ``own``, the language's ``lang_total`` and
    ``terms``, and ``p0``, the p of a kept term that the group lacks."""
    groups = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count("term").alias("own"), F.count_if(F.col("first") & F.col("term").isNotNull()).alias("firsts"))
    lang = Window.partitionBy("lang")  # rows are groups
    totals = groups.select("lang", "source", "total", "own", F.sum("total").over(lang).alias("lang_total"), F.sum("firsts").over(lang).alias("terms"))
    return totals.withColumn("p0", F.expr(p_sql("0", "total", "terms")))


def ranked_terms(kept: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """Part ``term``: the terms that a group uses most above its language."""
    cells = (kept.filter(F.col("term").isNotNull()).groupBy("lang", "source", "n", "n_lang").agg(F.count(F.lit(1)).alias("m"))
                 .join(totals, ["lang", "source"])
                 .withColumn("p", F.expr(p_sql("n", "total", "terms"))).withColumn("q", F.expr(p_sql("n_lang", "lang_total", "terms")))
                 .filter("p > q").withColumn("value", F.expr(f_sql("p", "q"))).select("lang", "source", "n", "n_lang", "m", "value"))
    cells = freeze(cells)
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    merged = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    # Every merged cell holds a term, so ranks up to `top` lie in the first `top` of them.
    first = merged.withColumn("_at", F.row_number().over(best)).filter(F.col("_at") <= top)
    before = first.withColumn("before", F.sum("m").over(best.rowsBetween(Window.unboundedPreceding, -1)))
    wanted = before.select("lang", "source", "value", F.coalesce("before", F.lit(0)).alias("before")).filter(F.col("before") < top)
    open_cells = sized_broadcast(cells.join(wanted, ["lang", "source", "value"]).select("lang", "source", "n", "n_lang", "value", "before"))
    inside = Window.partitionBy("lang", "source", "value").orderBy("term")
    terms = kept.filter(F.col("term").isNotNull()).join(open_cells, ["lang", "source", "n", "n_lang"])
    placed = terms.withColumn("_in", F.row_number().over(inside)).filter(F.col("_in") <= top)
    return placed.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value",
                         (F.col("before") + F.col("_in")).cast("int").alias("rank")).filter(F.col("rank") <= top)


def ranked_pairs(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """Part ``pair``: every other source of the language by its divergence."""
    terms = kept.filter(F.col("term").isNotNull())

    def side(name: str) -> DataFrame:
        return totals.select("lang", *[F.col(c).alias(f"{c}_{name}") for c in ("source", "total", "own", "p0")],
                             *([F.col("terms")] if name == "a" else []))

    pairs = side("a").join(side("b"), "lang").filter("source_a <> source_b")
    # Terms of one source against the other's value for an absent term, by cells of the one source.
    cells = terms.groupBy("lang", F.col("source").alias("source_a"), F.col("n").alias("n_a")).agg(F.count(F.lit(1)).alias("m"))
    own = (cells.join(side("a"), ["lang", "source_a"]).withColumn("p_a", F.expr(p_sql("n_a", "total_a", "terms")))
                .join(side("b"), "lang").filter("source_a <> source_b")
                .groupBy("lang", "source_a", "source_b").agg(F.sum(F.expr(f"m * {f_sql('p_a', 'p0_b')}")).alias("one_sided")))
    # Terms that both hold, by cells of both counts; each pair of sources once.
    left, right = (terms.select("lang", "term", F.col("source").alias(f"source_{s}"), F.col("n").alias(f"n_{s}")) for s in "ab")
    both = (left.join(right, ["lang", "term"]).filter("source_a < source_b")
                .groupBy("lang", "source_a", "source_b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("m"))
                .join(side("a"), ["lang", "source_a"]).join(side("b"), ["lang", "source_b"])
                .withColumn("p_a", F.expr(p_sql("n_a", "total_a", "terms"))).withColumn("p_b", F.expr(p_sql("n_b", "total_b", "terms")))
                .groupBy("lang", "source_a", "source_b")
                .agg(F.sum(F.expr(f"m * ({f_sql('p_a', 'p_b')} - {f_sql('p_a', 'p0_b')} - {f_sql('p0_a', 'p_b')} + {f_sql('p0_a', 'p0_b')})")).alias("both")))
    base = pairs.select("lang", F.struct("source_a", "source_b").alias("pair"),
                        F.expr(f"(terms - own_a - own_b) * {f_sql('p0_a', 'p0_b')}").alias("part"))
    # The value is the same both ways round.
    ways = F.explode(F.array(F.struct("source_a", "source_b"),
                             F.struct(F.col("source_b").alias("source_a"), F.col("source_a").alias("source_b")))).alias("pair")
    parts = base.unionByName(own.select("lang", ways, F.col("one_sided").alias("part"))).unionByName(
        both.select("lang", ways, F.col("both").alias("part")))
    values = parts.groupBy("lang", F.col("pair.source_a").alias("source"), F.col("pair.source_b").alias("item")).agg(
        F.coalesce(F.sum("part"), F.lit(0)).cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return values.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def source_audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                 min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    kept = freeze(kept_counts(term_counts(docs, text_col, lang_col, source_col), min_docs))
    totals = sized_broadcast(group_totals(kept))
    return ranked_pairs(kept, totals).unionByName(ranked_terms(kept, totals, top))
