"""Invariants over the real test tables (sf 0.001)."""

from pyspark.sql import functions as F

from lapse.config import LEDGER_WINDOW
from lapse.operators import cleaning as C
from lapse.operators import dataset as D
from lapse.operators import integrity as J
from lapse.operators import profiling as P
from lapse.operators import summaries as S
from lapse.plans.catalog import study
from lapse.sources.views import Tables
from tests.conftest import SF001


def test_frequencies_nest(spark):
    rfm = study(spark, SF001).rfm
    assert rfm.filter(~((F.col("freq_7d") <= F.col("freq_30d")) & (F.col("freq_30d") <= F.col("freq_90d")))).count() == 0
    assert rfm.filter(F.col("recency_days") < 0).count() == 0


def test_split_parts_disjoint_and_complete(spark):
    s = study(spark, SF001)
    model, split = s.model, s.split
    assert split.count() == model.count() == split.select("customer_id").distinct().count()
    assert set(r.split for r in split.select("split").distinct().collect()) <= {"train", "validation", "test"}
    # the order is respected: every train row precedes every test row
    mx = split.filter("split = 'train'").agg(F.max(F.struct("recency_days", "customer_id"))).first()[0]
    mn = split.filter("split = 'test'").agg(F.min(F.struct("recency_days", "customer_id"))).first()[0]
    assert tuple(mx) < tuple(mn)


def test_histogram_counts_sum_to_rows(spark):
    model = study(spark, SF001).model
    h = S.histogram_by(model, "inactive_next_60d", "recency_days")
    got = {r[0]: r[1] for r in h.groupBy("inactive_next_60d").agg(F.sum("n")).collect()}
    exp = {r[0]: r[1] for r in model.groupBy("inactive_next_60d").count().collect()}
    assert got == exp


def test_integrity_counts_add_up(spark):
    t = Tables(spark, SF001)
    r = J.referential_integrity(t.profile, t.ledger_intraday).first()
    assert r.n_both + r.n_parent_only == r.n_parent_keys
    assert r.n_both + r.n_child_only == r.n_child_keys
    assert J.keys_in_both(t.profile, t.ledger_intraday).count() == r.n_both
    assert J.keys_without(t.profile, t.ledger_intraday).count() == r.n_parent_only


def test_dedup_idempotent(spark):
    t = Tables(spark, SF001)
    once = C.dedup_exact(t.ledger_dup)
    assert C.dedup_exact(once).count() == once.count()
    r = C.dedup_stats(t.ledger_dup).first()
    assert r.rows_after == once.count() and r.rows_before == t.ledger_dup.count()


def test_correlation_symmetric_and_bounded(spark):
    m = {(r.feature_a, r.feature_b): r.corr for r in P.correlation_matrix(Tables(spark, SF001).profile).collect()}
    for (a, b), v in m.items():
        assert m[(b, a)] == v
        assert v is None or -1.0 <= v <= 1.0


def test_label_distribution_sums_to_100(spark):
    rows = D.label_distribution(study(spark, SF001).label).collect()
    assert abs(sum(r.pct for r in rows) - 100.0) < 0.2


def test_model_excludes_listed_columns(spark):
    cols = study(spark, SF001).model.columns
    assert "first_tx" not in cols and "last_tx" not in cols
    assert {"recency_days", "inactive_next_60d", "customer_segment"} <= set(cols)


def test_window_counts_match_filters(spark):
    tx = study(spark, SF001).tx_clean
    from lapse.operators import features as A
    r = A.window_counts(tx, LEDGER_WINDOW).first()
    assert r.n_observation == A.observation(tx, LEDGER_WINDOW).count()
    assert r.n_target == A.target_window(tx, LEDGER_WINDOW).count()


def test_schema_of_one_read_is_not_used_by_the_next(spark, tmp_path):
    from lapse.sources import read_table
    path = str(tmp_path / "t")
    spark.range(3).selectExpr("id", "id * 2 AS twice").write.parquet(path)
    assert read_table(spark, path, schema="id long").columns == ["id"]
    assert read_table(spark, path).columns == ["id", "twice"]
    spark.range(3).selectExpr("id", "id AS other").write.mode("overwrite").parquet(path)
    assert read_table(spark, path).columns == ["id", "other"]


def test_means_keep_digits_past_the_scale(spark):
    from pyspark.sql import functions as F

    from lapse.functions.numeric import exact_mean
    df = spark.createDataFrame([(1, 0.004), (1, 0.004), (1, 0.006), (2, 1e17), (3, 0.1), (3, 0.2), (3, None)], "k int, x double")
    got = {r.k: r.m for r in df.groupBy("k").agg(exact_mean(F.col("x")).alias("m")).collect()}
    assert abs(got[1] - 0.014 / 3) < 1e-12 and got[2] == 1e17 and got[3] == 0.15


def test_pairs_rank_by_raw_correlation(spark):
    from lapse.operators import profiling as P
    df = spark.createDataFrame([(i, i + 0.001 * (i % 7), i + 0.002 * (i % 5) * (i % 3)) for i in map(float, range(40))], "a double, b double, c double")
    raw = {(x, y): df.toPandas()[x].corr(df.toPandas()[y]) for x, y in (("a", "b"), ("a", "c"), ("b", "c"))}
    got = [(r.feature_a, r.feature_b) for r in P.correlation_pairs(df, ["a", "b", "c"]).collect()]
    assert got == sorted(raw, key=lambda k: -raw[k])


def test_split_of_dates_texts_and_nulls(spark):
    import datetime as dt

    from lapse.operators import dataset as D
    for rows, kind in (([(None if i % 9 == 0 else dt.date(2024, 1, 1 + i % 5), f"c{i}") for i in range(50)], "date"), ([(3, f"c{i}") for i in range(50)], "int")):
        df = spark.createDataFrame(rows, f"o {kind}, k string")
        want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]) if kind == "int" else (r[0] is None, r[0] or dt.date.min, r[1]))
        for block in (7, 1000):
            got = {r.k: r.split for r in D.ordered_split(df, order_col="o", tie_col="k", rows_per_block=block).collect()}
            assert [got[k] for _, k in want] == ["train"] * 35 + ["validation"] * 7 + ["test"] * 8
