"""One literal-row test per semantic trap (expected values written by hand)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lapse.config import StudyWindow
from lapse.functions import half_even
from lapse.operators import dataset as D
from lapse.operators import features as A
from lapse.operators import profiling as P
from lapse.operators import summaries as S
from lapse.sources import nan_to_null

W = StudyWindow(cutoff="2023-11-30", pop_start="2023-10-01",
                target_lo="2023-12-01", target_hi="2023-12-29")
LEDGER = "customer_id bigint, date timestamp_ntz, amount double, type string"
CUT = dt.datetime(2023, 11, 30)


def ledger(spark, rows):
    return spark.createDataFrame(rows, LEDGER)


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_t1_windows_are_inclusive(spark):
    df = ledger(spark, [(1, CUT - dt.timedelta(days=7), 10.0, "a"),
                        (1, CUT - dt.timedelta(days=8), 20.0, "a")])
    r = one(A.rfm_features(df, W))
    assert (r.freq_7d, r.freq_30d, r.freq_90d) == (1, 2, 2)
    assert r.avg_value_90d == 15.0


def test_t2_intraday_rows_after_midnight_bound(spark):
    df = ledger(spark, [(1, CUT, 1.0, "a"), (2, CUT + dt.timedelta(hours=12), 1.0, "a"),
                        (3, dt.datetime(2023, 12, 29, 6), 1.0, "a")])
    r = one(A.window_counts(df, W))
    assert (r.n_observation, r.n_target) == (1, 0)
    assert [x.customer_id for x in A.observation(df, W).collect()] == [1]


def test_t3_recency_counts_whole_days(spark):
    df = ledger(spark, [(1, CUT - dt.timedelta(hours=11), 1.0, "a"),
                        (2, CUT - dt.timedelta(hours=36), 1.0, "a")])
    got = {r.customer_id: r.recency_days for r in A.rfm_features(df, W).collect()}
    assert got == {1: 0, 2: 1}


def test_t4_half_even_on_binary_values(spark):
    r = spark.range(1).select(half_even(F.lit(0.03125), 4).alias("a"),
                              half_even(F.lit(37760.245), 2).alias("b"),
                              half_even(F.lit(2.5), 0).alias("c")).first()
    assert (r.a, r.b, r.c) == (0.0312, 37760.25, 2.0)


def test_t4_rate_of_change_keeps_formula(spark):
    # 29 rows in 90 days, 10 of them in the last 30: (10 - 29/3) / (29/3 + 1)
    rows = [(1, CUT - dt.timedelta(days=40 + i), 1.0, "a") for i in range(19)]
    rows += [(1, CUT - dt.timedelta(days=i), 1.0, "a") for i in range(10)]
    r = one(A.rfm_features(ledger(spark, rows), W))
    expected = (10 - 29 / 3) / (29 / 3 + 1)
    assert r.freq_30d_change == round(expected, 4)


def test_t5_split_sizes_use_binary_float(spark):
    df = spark.range(90).select(F.col("id").alias("customer_id"), (F.col("id") % 7).alias("recency_days"))
    sizes = {r.split: r.n for r in D.split_sizes(D.ordered_split(df, rows_per_block=5)).collect()}
    assert sizes == {"train": 62, "validation": 13, "test": 15}


def test_t6_split_is_positional_with_tie_key(spark):
    df = spark.range(20).select(F.col("id").alias("customer_id"), F.lit(3).alias("recency_days"))
    got = {r.customer_id: r.split for r in D.ordered_split(df, rows_per_block=3).collect()}
    assert [got[i] for i in range(20)] == ["train"] * 14 + ["validation"] * 3 + ["test"] * 3


def test_t7_null_keys_do_not_form_a_group(spark):
    df = ledger(spark, [(None, CUT, 1.0, "a"), (1, CUT, 1.0, "a")])
    assert [r.customer_id for r in A.rfm_features(df, W).collect()] == [1]
    df = ledger(spark, [(None, dt.datetime(2023, 11, 1), 1.0, "a")])
    assert A.inactivity_label(df, W).count() == 0


def test_t8_nan_is_missing(spark):
    df = nan_to_null(spark.createDataFrame([(1.0,), (float("nan"),)], "x double"))
    r = df.agg(F.avg("x").alias("m"), F.count_if(F.col("x").isNull()).alias("n")).first()
    assert (r.m, r.n) == (1.0, 1)


def test_t9_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (3.0, 3.0)], "a double, b double")
    rows = {(r.feature_a, r.feature_b): r.corr for r in P.correlation_matrix(df, ["a", "b"]).collect()}
    assert rows[("a", "a")] == 1.0
    assert rows[("a", "b")] is None and rows[("b", "b")] is None


def test_t9_pairwise_deletion(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, None), (4.0, 3.0)], "a double, b double")
    r = one(P.correlation_pairs(df, ["a", "b"], k=1))
    # complete pairs (1,1), (2,2), (4,3)
    import statistics
    assert r.corr == round(statistics.correlation([1, 2, 4], [1, 2, 3]), 3)


def test_t10_reindex_drops_unlisted_and_adds_missing(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 3), (3, "zzz", 5), (4, None, 7)],
                               "customer_id bigint, customer_segment string, tx_count bigint")
    rows = P.segment_summary(df, ["b", "a"], metrics=["tx_count"]).collect()
    assert [r.customer_segment for r in rows] == ["b", "a"]
    assert rows[0].customer_count is None and rows[0].mean_tx_count is None
    assert (rows[1].customer_count, rows[1].mean_tx_count) == (2, 2.0)
    share = S.segment_share(df, ["b", "a"]).collect()
    assert [(r.customer_segment, r.n, r.pct) for r in share] == [("b", None, None), ("a", 2, 50.0)]


def test_t11_t12_encoder_sorted_train_classes_unseen_to_zero(spark):
    df = spark.createDataFrame([(1, "b", "train"), (2, "a", "train"), (3, None, "train"), (4, "z", "validation")],
                               "customer_id bigint, g string, split string")
    classes = D.fit_encoder(df.filter("split = 'train'"), ["g"])
    assert sorted((r.value, r.code) for r in classes.collect()) == [("None", 0), ("a", 1), ("b", 2)]
    enc = {r.customer_id: r.g_enc for r in D.apply_encoder(df, classes, ["g"]).collect()}
    assert enc == {1: 2, 2: 1, 3: 0, 4: 0}


def test_t12_booleans_print_like_python(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert sorted(r.value for r in D.fit_encoder(df, ["f"]).collect()) == ["False", "None", "True"]


def test_t13_histogram_edges_and_constant_group(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 200.0), (1, 3.0), (1, 3.0)], "g int, x double")
    rows = [r for r in S.histogram_by(df, "g", "x", bins=40, clip=200.0).collect() if r.n > 0]
    assert [(r.g, r.bin, r.n) for r in rows] == [(0, 0, 1), (0, 39, 1), (1, 20, 2)]
    full = S.histogram_by(df, "g", "x", bins=40).collect()
    assert len(full) == 80 and sum(r.n for r in full) == 4


def test_t13_clip(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 500.0), (0, 100.0)], "g int, x double")
    rows = [r for r in S.histogram_by(df, "g", "x", bins=40, clip=200.0).collect() if r.n > 0]
    assert [(r.bin, r.n) for r in rows] == [(0, 1), (20, 1), (39, 1)]
    assert rows[-1].bin_hi == 200.0


def test_t14_describe_quartiles_and_sample_std(spark):
    df = spark.createDataFrame([("s", v) for v in [1, 2, 3, 10]], "customer_segment string, tx_count bigint")
    r = one(S.describe_by(df, ["s"], digits=4))
    assert (r.q25, r.q50, r.q75, r.std, r["count"]) == (1.75, 2.5, 4.75, 4.0825, 4.0)


def test_boxplot_whiskers_exclude_outliers(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([("s", v) for v in vals], "customer_segment string, tx_count bigint")
    r = one(S.boxplot_stats(df, ["s"]))
    # numpy: q1 3, q3 7, iqr 4, fences -3 and 13
    assert (r.q1, r.median, r.q3, r.whisker_low, r.whisker_high, r.n_outliers) == (3.0, 5.0, 7.0, 1.0, 8.0, 1.0)


def test_label_population_and_target(spark):
    rows = [(1, dt.datetime(2023, 10, 5), 1.0, "a"), (1, dt.datetime(2023, 12, 2), 1.0, "a"),
            (2, dt.datetime(2023, 11, 30), 1.0, "a"),
            (3, dt.datetime(2023, 9, 1), 1.0, "a"), (3, dt.datetime(2023, 12, 3), 1.0, "a"),
            (4, dt.datetime(2023, 12, 30), 1.0, "a"), (4, dt.datetime(2023, 10, 1), 1.0, "a")]
    got = {r.customer_id: r.inactive_next_60d for r in A.inactivity_label(ledger(spark, rows), W).collect()}
    assert got == {1: 0, 2: 1, 4: 1}


def test_study_window_validates_order():
    with pytest.raises(ValueError):
        StudyWindow(cutoff="2023-11-30", pop_start="2023-12-01", target_lo="2023-12-01", target_hi="2023-12-29")


def test_mean_name_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, "a", 1, 2)], "customer_id bigint, customer_segment string, "
                               "abcdefghijklmnopqrX bigint, abcdefghijklmnopqrY bigint")
    with pytest.raises(ValueError):
        P.segment_summary(df, ["a"], metrics=["abcdefghijklmnopqrX", "abcdefghijklmnopqrY"])


def test_ordered_split_string_tie_key(spark):
    df = spark.createDataFrame([(f"c{i:02d}", i % 3) for i in range(10)], "customer_id string, recency_days int")
    got = sorted((r.recency_days, r.customer_id, r.split) for r in D.ordered_split(df).collect())
    assert [s for *_, s in got] == ["train"] * 7 + ["validation"] + ["test"] * 2
    assert not math.isnan(len(got))


def test_quantiles_are_exact(spark):
    df = spark.createDataFrame([("s", v) for v in range(1, 1001)], "customer_segment string, tx_count bigint")
    exact = one(S.describe_by(df, ["s"], digits=4))
    assert (exact.q25, exact.q50, exact.q75) == (250.75, 500.5, 750.25)


def test_t3_recency_ignores_session_time_zone(spark):
    # US clocks spring forward on 2023-03-12: in that zone the span from
    # 03-10 00:00 to 03-20 00:00 is 10 days minus an hour of real time.
    w = StudyWindow(cutoff="2023-03-20", pop_start="2023-03-01", target_lo="2023-03-21", target_hi="2023-03-25")
    df = ledger(spark, [(1, dt.datetime(2023, 3, 10, 0, 0), 1.0, "a"),
                        (2, dt.datetime(2023, 3, 9, 12, 0), 1.0, "a")])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = {r.customer_id: r.recency_days for r in A.rfm_features(df, w).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {1: 10, 2: 10}


def test_one_pass_features_equal_join_of_parts(spark):
    rows = [(c, CUT - dt.timedelta(days=d, hours=h), float(10 * c + d), "a")
            for c in range(1, 6) for d in (0, 3, 20, 45, 80, 100) for h in (0, 5) if (c + d) % 3]
    rows += [(c, dt.datetime(2023, 12, 2 + c), 1.0, "a") for c in (1, 3)]
    rows += [(9, dt.datetime(2023, 12, 5), 1.0, "a"), (None, CUT, 1.0, "a")]
    df = ledger(spark, rows)
    one_pass = sorted(tuple(r) for r in A.rfm_with_label(df, W).collect())
    parts = A.rfm_features(df, W).join(A.inactivity_label(df, W), "customer_id")
    assert one_pass == sorted(tuple(r) for r in parts.collect())
    assert len(one_pass) == 5


def test_t15_calendar_days_truncate_both_ends(spark):
    from lapse.operators import cleaning as C
    df = ledger(spark, [(1, dt.datetime(2024, 1, 1, 10), 1.0, "a"), (1, dt.datetime(2024, 1, 1, 23), 1.0, "a"),
                        (2, dt.datetime(2024, 1, 4, 9), 1.0, "a")])
    r = one(C.date_coverage(df))
    assert (r.min_date, r.max_date) == (dt.date(2024, 1, 1), dt.date(2024, 1, 4))
    assert (r.calendar_days, r.active_days, r.empty_days) == (4, 2, 2)


def test_t16_t17_bottom_pairs_and_mean_names(spark):
    df = spark.createDataFrame([(float(i), float(i * i), float(10 - i), float(i % 3)) for i in range(10)],
                               "a double, b double, c double, d double")
    low = [(r.feature_a, r.feature_b) for r in P.correlation_pairs(df, ["a", "b", "c", "d"], k=2, largest=False).collect()]
    assert low[0] == ("a", "c")  # exactly -1, the lowest pair
    assert P.mean_name("support_tickets_count") == "mean_support_tickets_co"


def test_encoder_ranks_do_not_depend_on_parts(spark):
    from lapse.plans.catalog import study
    from tests.conftest import SF01
    split = study(spark, SF01).split
    train = split.filter("split = 'train'")
    cols = ["income_bracket", "location", "customer_segment"]
    small = sorted(tuple(r) for r in D.fit_encoder(train, cols).collect())
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:  # many small parts, not merged
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        parts = sorted(tuple(r) for r in D.fit_encoder(train, cols).collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert small == parts and len(small) > 20
    # unicode and prefixes sort by bytes, like the sorted classes of a label encoder
    df = spark.createDataFrame([(v,) for v in ["b", "a", "ab", "abcdefgh1", "abcdefgh0", "Z", "é", "zz"]], "g string")
    got = {r.value: r.code for r in D.fit_encoder(df, ["g"]).collect()}
    assert [v for v, _ in sorted(got.items(), key=lambda kv: kv[1])] == sorted(got, key=lambda v: v.encode())
