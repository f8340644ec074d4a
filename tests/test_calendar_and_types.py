"""Generated calendar days, distinct types by range parts, filled cells, NaN in a registered view."""

import datetime as dt

from pyspark.sql import functions as F

from lapse.operators import cleaning as C
from lapse.operators import profiling as P
from lapse.sources.views import Tables
from tests.conftest import SF001


def test_empty_days_and_their_gaps(spark):
    d = dt.date
    rows = [(d(2024, 2, 27),), (d(2024, 2, 27),), (d(2024, 3, 2),), (d(2024, 3, 4),), (None,)]
    df = spark.createDataFrame(rows, "date date")
    assert [(r["date"], r["n_rows"]) for r in C.daily_calendar(df).collect()] == [
        (d(2024, 2, 27), 2), (d(2024, 2, 28), 0), (d(2024, 2, 29), 0), (d(2024, 3, 1), 0), (d(2024, 3, 2), 1), (d(2024, 3, 3), 0), (d(2024, 3, 4), 1)]
    assert [tuple(r) for r in C.empty_days(df).collect()] == [
        (d(2024, 2, 28), d(2024, 2, 28), 3), (d(2024, 2, 29), d(2024, 2, 28), 3), (d(2024, 3, 1), d(2024, 2, 28), 3), (d(2024, 3, 3), d(2024, 3, 3), 1)]
    assert C.empty_days(df).count() == C.date_coverage(df).first()["empty_days"]
    assert C.empty_days(df.limit(0)).collect() == [] and C.daily_calendar(df.filter("date IS NULL")).collect() == []


def test_free_text_types_are_listed_one_per_row(spark):
    df = spark.range(3000).select(F.concat(F.lit("type "), (F.col("id") % 1000).cast("string")).alias("type")).unionByName(
        spark.createDataFrame([(None,), ("",)], "type string"))
    got = [tuple(r) for r in P.ledger_types(df).orderBy("position").collect()]
    assert got == [(1, "", 1)] + [(i + 2, t, 3) for i, t in enumerate(sorted(f"type {i}" for i in range(1000)))]
    plan = P.ledger_types(df)._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "Exchange" not in plan


def test_profile_of_a_ledger_gathers_no_set(spark):
    out = P.ledger_profile(Tables(spark, SF001).ledger)
    assert "collect_set" not in out._jdf.queryExecution().executedPlan().toString()


def test_profile_of_a_ledger_lists_its_types(spark):
    schema = "customer_id int, date timestamp_ntz, amount double, type string"
    day = lambda d: dt.datetime(2024, 1, d, 9)
    df = spark.createDataFrame([(1, day(2), 2.0, "b"), (2, day(1), 5.0, "a"), (1, day(2), 2.0, "b"), (None, None, None, "é"), (3, day(3), 1.0, None), (3, day(3), 1.0, "")], schema)
    assert [r.asDict() for r in P.ledger_profile(df).collect()] == [
        {"min_date": dt.date(2024, 1, 1), "max_date": dt.date(2024, 1, 3), "n_customers": 3, "types": ",a,b,é", "n_types": 4, "amount_min": 1.0, "amount_max": 5.0}]
    assert [(r.types, r.n_types) for r in P.ledger_profile(df.filter("type IS NULL")).collect()] == [(None, 0)]
    assert [(r.types, r.n_customers) for r in P.ledger_profile(df.limit(0)).collect()] == [(None, 0)]
    other = P.ledger_profile(df.withColumnRenamed("type", "the type"), type_col="the type").first()
    assert other.types == ",a,b,é"


def test_overview_counts_filled_cells(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, `b c` double, s string")
    assert [tuple(r) for r in P.column_overview(df).collect()] == [(1, "a", "int", 2), (2, "b c", "double", 0), (3, "s", "string", 1)]
    assert [tuple(r) for r in C.exclusion_report(df, ["s", "gone"]).collect()] == [("s", True, "excluded", 1.0), ("gone", False, "not in data", None)]
    assert C.exclusion_report(df, []).collect() == []


def test_wide_profile_reads_nan_as_null(spark):
    t = Tables(spark, SF001)
    wide = t.wide_profile
    raw = t.table("events").filter("user_id % 7 = 0").select(F.col("user_id").alias("customer_id")).distinct()
    nan_users = wide.join(raw, "customer_id", "semi")
    assert nan_users.count() > 0 and nan_users.filter("nps_score IS NOT NULL").count() == 0
    assert set(P.SEGMENT_METRICS) | set(P.CORR_FEATURES) <= set(wide.columns)
