"""Quality rules as a bitmask ledger (DataFrame functions only).

``measure`` evaluates every measurement and every rule once per document and
stores the failures as bits of one long.  Policies are versioned sets of rules:
``decide`` is one bitwise AND over the stored ledger, and ``ablations`` reports
from the same ledger what each rule of a policy rejects, alone and with others,
without touching the texts again.

Results for odd input: a null text has no words and no lines (all measurements
0, ``too_few_words`` fails); texts of any length are measured whole; repeated rows give repeated results; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import col, words

# Rules in the order of their bits; a bit never changes its meaning, new rules go to the end.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 40 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 12 * n_words",
    "no_lower_case": "n_words > 0 AND 2 * n_shouted > n_words",
}
# Versioned policies: the rules whose failure rejects a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("too_few_words", "repeated_words"),
    "v2": ("too_few_words", "repeated_words", "symbols", "repeated_lines", "word_length"),
    "v3": ("too_few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "no_lower_case"),
}
BASE_POLICY, CURRENT_POLICY = "v1", "v3"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_shouted")
_BIT = {name: 1 << i for i, name in enumerate(RULES)}


def policy_mask(policy: str) -> int:
    return sum(_BIT[rule] for rule in POLICIES[policy])


# The steps below each read a column of the step before: inside a lambda an expression is
# evaluated anew for every element, a column is not.

def _hashes(w: Column) -> Column:
    """A hash of each three-word window."""
    hashed = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 4, F.array().cast("array<bigint>")).otherwise(F.slice(hashed, F.lit(1), F.size(w) - 2))


def _located(hashes: Column) -> Column:
    """(hash, position) sorted; null where a hash set shows that no window occurs twice."""
    at = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("k"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), at)


def _spelled(w: Column, positions: Column) -> Column:
    """(window as a string, position) sorted, for the positions whose hash occurs twice: so a hash
    collision cannot make two windows equal (words hold no spaces, so the strings cannot either)."""
    return F.sort_array(F.transform(positions, lambda p: F.struct(
        F.concat_ws(" ", F.get(w, p), F.get(w, p + 1), F.get(w, p + 2)).alias("k"), p.alias("p"))))


def _twice(at: Column) -> Column:
    """Sorted positions of the keys that occur twice or more; get() gives null outside the array."""
    same = F.filter(at, lambda x, i: F.coalesce(x["k"] == F.get(at, i - 1)["k"], F.lit(False))
                    | F.coalesce(x["k"] == F.get(at, i + 1)["k"], F.lit(False)))
    return F.sort_array(F.transform(same, lambda x: x["p"]))


def _stretch(positions: Column) -> Column:
    """Sum of min(3, distance to the next position): the union of [p, p + 3)."""
    steps = F.transform(positions, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(positions, i + 1) - p, F.lit(3))))
    return F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """The ledger: id, every measurement (long) and ``failures`` (long, a bit per rule of RULES).

    ``keep`` names input columns that are carried along, in one struct column ``kept_columns``.
    """
    text = col(text_col).cast("string")
    carried = [F.struct(*[col(c) for c in keep]).alias("kept_columns")] if keep else []
    carry = ["kept_columns"] if keep else []
    split = docs.select(col(id_col).alias("_id"), *carried, text.alias("_t"),
                        words(F.coalesce(text, F.lit(""))).alias("_w"),
                        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    counted = split.select(
        "_id", *carry, F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count("_t", F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("long").alias("n_symbols"),
        F.coalesce(F.size("_l"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_l") - F.size(F.array_distinct("_l")), F.lit(0)).cast("long").alias("n_dup_lines"),
        F.coalesce(F.regexp_count("_t", F.lit(r"(?<![^\x20\x09-\x0D])\p{Lu}\p{Lu}+(?![\p{Ll}])")), F.lit(0)).cast("long").alias("n_shouted"),
        "_w", _hashes(F.col("_w")).alias("_h"))
    repeated = (counted.withColumn("_at", _located(F.col("_h"))).withColumn("_p", _twice(F.col("_at")))
                .withColumn("_s", _spelled(F.col("_w"), F.col("_p"))).withColumn("_p", _twice(F.col("_s"))))
    measured = repeated.select("_id", *carry, *[m for m in MEASURES if m != "n_repeat_words"],
                               _stretch(F.col("_p")).alias("n_repeat_words"))
    bits = F.lit(0).cast("long")
    for name, rule in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(_BIT[name])).otherwise(F.lit(0)).cast("long"))
    row = F.struct(F.col("_id").alias(id_col), *carry, *MEASURES, bits.alias("failures"))
    # As a generator's output: a filter on a measurement must not be pushed below the steps above,
    # where it would repeat them inside their lambdas.
    return measured.select(F.inline(F.array(row)))


def decide(ledger: DataFrame, policy: str = CURRENT_POLICY, name: str = "kept") -> DataFrame:
    """The ledger with a boolean: true where no rule of the policy failed."""
    return ledger.withColumn(name, F.col("failures").bitwiseAND(F.lit(policy_mask(policy))) == 0)


def ablations(ledger: DataFrame, policy: str = CURRENT_POLICY) -> DataFrame:
    """Per rule of a policy: documents it fails, documents only it fails, and documents kept without it.

    One pass: masked failures are counted per distinct mask (at most 2**rules rows), the rest is
    bitwise arithmetic on those counts.
    """
    mask = policy_mask(policy)
    masks = ledger.groupBy(F.col("failures").bitwiseAND(F.lit(mask)).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    rows = []
    for rule in POLICIES[policy]:
        bit = _BIT[rule]
        rows.append(F.struct(
            F.lit(policy).alias("policy"), F.lit(rule).alias("rule"),
            F.coalesce(F.sum(F.when(F.col("m").bitwiseAND(F.lit(bit)) != 0, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(F.col("m") == bit, F.col("n"))), F.lit(0)).alias("n_failed_alone"),
            F.coalesce(F.sum(F.when(F.col("m").bitwiseAND(F.lit(mask & ~bit)) == 0, F.col("n"))), F.lit(0)).alias("n_kept_without"),
            F.coalesce(F.bit_or("m"), F.lit(0)).alias("seen_failures")))
    return masks.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def keep_clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               policy: str = CURRENT_POLICY) -> DataFrame:
    """``docs`` without the rows that fail the policy; all columns as they came."""
    ledger = decide(measure(docs, id_col, text_col, keep=tuple(docs.columns)), policy, "_ok")
    return ledger.where("_ok").select("kept_columns.*")


def quality_rules(docs: DataFrame, policy: str = CURRENT_POLICY) -> DataFrame:
    """Digest of the ledger: the base measurements, ``base_failed`` and the policy's verdict ``kept``."""
    ledger = decide(decide(measure(docs), BASE_POLICY, "_base"), policy)
    return ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (~F.col("_base")).alias("base_failed"), (F.col("_base") & F.col("kept")).alias("kept"), "failures")
