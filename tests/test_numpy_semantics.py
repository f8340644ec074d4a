"""Randomized checks of the operators that follow numpy/pandas semantics,
against numpy and pandas themselves on the same small inputs."""

import numpy as np
import pandas as pd
import pytest

from lapse.operators import profiling as P
from lapse.operators import summaries as S


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_histogram_matches_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    data = {0: rng.integers(0, 250, 300).astype(float), 1: rng.uniform(-3.7, 91.3, 200),
            2: np.full(5, 7.0)}
    rows = [(g, float(v)) for g, vals in data.items() for v in vals]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {(r.g, r.bin): (r.n, r.bin_lo, r.bin_hi) for r in S.histogram_by(df, "g", "x", bins=40, clip=200.0).collect()}
    for g, vals in data.items():
        counts, edges = np.histogram(np.minimum(vals, 200.0), bins=40)
        for b in range(40):
            n, lo, hi = got[(g, b)]
            assert n == counts[b], (g, b)
            assert lo == np.round(edges[b], 4) and hi == np.round(edges[b + 1], 4)


@pytest.mark.parametrize("seed", [4, 5])
def test_describe_and_boxplot_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    groups = {"a": rng.integers(0, 60, 101), "b": np.append(rng.integers(10, 20, 40), [90, 95, -40]), "c": np.array([5])}
    rows = [(g, int(v)) for g, vals in groups.items() for v in vals]
    df = spark.createDataFrame(rows, "customer_segment string, tx_count bigint")
    desc = {r.customer_segment: r for r in S.describe_by(df, ["a", "b", "c"], digits=6).collect()}
    box = {r.customer_segment: r for r in S.boxplot_stats(df, ["a", "b", "c"]).collect()}
    for g, vals in groups.items():
        s = pd.Series(vals.astype(float)).describe()
        d = desc[g]
        for col, key in [("mean", "mean"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")]:
            assert d[col] == pytest.approx(round(s[key], 6), abs=1e-9)
        if len(vals) > 1:
            assert d["std"] == pytest.approx(round(s["std"], 6), abs=1e-9)
        q1, med, q3 = np.percentile(vals, [25, 50, 75])
        iqr = q3 - q1
        inside_hi = vals[vals <= q3 + 1.5 * iqr]
        inside_lo = vals[vals >= q1 - 1.5 * iqr]
        whi = q3 if len(inside_hi) == 0 or inside_hi.max() < q3 else inside_hi.max()
        wlo = q1 if len(inside_lo) == 0 or inside_lo.min() > q1 else inside_lo.min()
        b = box[g]
        assert (b.q1, b.median, b.q3) == (q1, med, q3)
        assert (b.whisker_low, b.whisker_high) == (wlo, whi)
        assert b.n_outliers == ((vals < wlo) | (vals > whi)).sum()


@pytest.mark.parametrize("seed", [6, 7])
def test_correlation_matches_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    n = 200
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.normal(size=n), "c": np.ones(n)})
    pdf["b"] = pdf["a"] * 0.6 + pdf["b"]
    pdf.loc[rng.choice(n, 30, replace=False), "a"] = np.nan
    pdf.loc[rng.choice(n, 20, replace=False), "b"] = np.nan
    df = spark.createDataFrame([tuple(None if pd.isna(v) else float(v) for v in r) for r in pdf.itertuples(index=False)],
                               "a double, b double, c double")
    got = {(r.feature_a, r.feature_b): r.corr for r in P.correlation_matrix(df, ["a", "b", "c"], digits=6).collect()}
    exp = pdf.corr()
    for x in "abc":
        for y in "abc":
            e = exp.loc[x, y]
            if pd.isna(e):
                assert got[(x, y)] is None
            else:
                assert got[(x, y)] == pytest.approx(round(e, 6), abs=1.1e-6)
