"""Exact percentiles by bracket and select, and operators without any listed column."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapse.functions.quantiles import exact_quantiles
from lapse.operators import profiling as P
from lapse.operators import summaries as S


def test_continuous_column_matches_numpy(spark):
    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(size=5000).tolist(), "b": [7.0] * 4000 + rng.exponential(size=501).tolist(), "c": [1.5], "d": [1.0, 2.0]}
    df = spark.createDataFrame([(g, float(x)) for g, xs in groups.items() for x in xs] + [("a", None), ("e", None), (None, 1.0)], "g string, x double")
    got = {r["g"]: r["_q"] for r in exact_quantiles(df.repartition(8), "g", "x", [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        assert got[g] == pytest.approx(np.percentile(xs, [0, 25, 50, 90, 100]).tolist(), abs=1e-12)


def test_summaries_use_no_percentile_state(spark):
    df = spark.range(200).select(F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("customer_segment"),
                                 (F.col("id") * 1.1).alias("tx_count"))
    plans = [S.describe_by(df, ["x", "y", "z"]), S.boxplot_stats(df, ["x", "y", "z"]), S.group_center(df, "customer_segment", "tx_count")]
    for out in plans:
        text = out._jdf.queryExecution().toString()
        assert not re.search(r"(?<!\w)(percentile|median|percentile_cont|collect_list)\(", text)  # the bounded sketch alone
    rows = {r["customer_segment"]: r for r in plans[0].collect()}
    assert rows["x"]["q50"] == pytest.approx(round(np.median([i * 1.1 for i in range(0, 200, 3)]), 1))
    assert rows["z"]["count"] is None


def test_no_listed_column_gives_empty_results(spark):
    df = spark.createDataFrame([("x", 1.0)], "customer_segment string, other double")
    assert P.correlation_matrix(df).collect() == []
    assert P.correlation_pairs(df).collect() == []
    assert P.correlation_lower(df, ["nothing"]).collect() == []
    assert P.target_correlation(df, ["nothing"], "other").collect() == []
    assert P.structural_missing_check(df).collect() == []
    out = S.metric_means(df, ["x"])
    assert out.columns == ["metric", "customer_segment", "mean"] and out.collect() == []


@pytest.mark.parametrize("accuracy", [40, 100, 10_000])
def test_brackets_hold_the_wanted_ranks_at_every_size(spark, accuracy):
    """Small sketches, group sizes around every reach, ties, heavy tails."""
    rng = np.random.default_rng(accuracy)
    sizes = [1, 2, 3, 5, 39, 40, 41, 99, 100, 101, 399, 400, 401, 2500]
    groups = {f"g{n}": (rng.integers(0, 7, n) if i % 3 == 0 else rng.standard_cauchy(n) if i % 3 == 1 else np.sort(rng.exponential(size=n))).astype(float).tolist()
              for i, n in enumerate(sizes)}
    df = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "g string, x double").repartition(8)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r["g"]: r["_q"] for r in exact_quantiles(df, "g", "x", probs, accuracy=accuracy).collect()}
    for g, xs in groups.items():
        assert got[g] == pytest.approx(np.percentile(xs, [p * 100 for p in probs]).tolist(), rel=1e-12, abs=1e-12)


def test_only_the_bracket_is_sorted(spark):
    df = spark.range(200_000).select(F.lit("a").alias("g"), F.hash("id").cast("double").alias("x"))
    want = np.percentile([r["x"] for r in df.collect()], [25, 50])
    out = exact_quantiles(df, "g", "x", [0.25, 0.5], also=[F.count("x").alias("n")])
    row = out.first()
    assert row["n"] == 200_000 and row["_q"] == pytest.approx(want.tolist())


def test_groups_without_values_keep_their_other_aggregates(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "g string, x double")
    got = {r["g"]: (r["n"], r["_q"]) for r in exact_quantiles(df, "g", "x", [0.5], also=[F.count(F.lit(1)).alias("n")]).collect()}
    assert got == {"a": (1, None), "b": (1, [2.0])}
