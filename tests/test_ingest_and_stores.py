"""Rejected rows, the monthly ledger and the bucketed tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lapse.config import LEDGER_WINDOW, StudyWindow
from lapse.operators import cleaning as C
from lapse.operators import features as A
from lapse.operators import integrity as J
from lapse.sources.keyed_store import KeyedStore, customer_days
from lapse.sources.ledger_store import LedgerStore
from lapse.sources.rejects import read_with_rejects, reject_summary
from lapse.sources.views import Tables
from tests.conftest import SF001


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- rejected rows -----------------------------------------------------------------

SCHEMA = "customer_id bigint, date string, amount double, type string"
LINES = ["customer_id,date,amount,type", "1,2023-01-05,10.5,card", "2,2023-13-05,1,card", "x,2023-01-05,1,card", "3,2023-01-06,,", "4,2023-01-07",
         "5,2023-01-08,1,card,more", "6,,2,cash", "7,2023-01-09,n/a,cash", "8,2023-01-10,NaN,cash"]


def write(tmp_path, lines):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_rows_in_are_rows_kept_plus_rejected(spark, tmp_path):
    kept, rejected = read_with_rejects(spark, write(tmp_path, LINES), SCHEMA, {"date": "yyyy-MM-dd"}, work_path=str(tmp_path / "out"))
    assert dict(kept.dtypes)["date"] == "timestamp_ntz"
    assert rows_of(kept) == sorted([(1, dt.datetime(2023, 1, 5), 10.5, "card"), (3, dt.datetime(2023, 1, 6), None, None), (6, None, 2.0, "cash"),
                                    (8, dt.datetime(2023, 1, 10), None, "cash")], key=str)
    assert rows_of(rejected) == sorted([("date: date", "2,2023-13-05,1.0,card"), ("malformed", "x,2023-01-05,1,card"), ("malformed", "4,2023-01-07"),
                                        ("malformed", "5,2023-01-08,1,card,more"), ("malformed", "7,2023-01-09,n/a,cash")], key=str)
    assert sum(r["n_rows"] for r in reject_summary(kept, rejected).collect()) == len(LINES) - 1


def test_empty_file_and_nothing_rejected(spark, tmp_path):
    kept, rejected = read_with_rejects(spark, write(tmp_path, LINES[:1]), SCHEMA, {"date": None})
    assert kept.collect() == [] and rejected.collect() == []
    assert {r["outcome"]: r["n_rows"] for r in reject_summary(kept, rejected).collect()} == {"kept": 0}


def test_one_job_writes_both_outputs(spark, tmp_path):
    kept, rejected = read_with_rejects(spark, write(tmp_path, LINES), SCHEMA, {"date": None}, work_path=str(tmp_path / "out"))
    assert all("/out/_rejected=false/" in f for f in kept.inputFiles()) or "_rejected" in plan(kept)
    assert "csv" not in plan(kept).lower() and "csv" not in plan(rejected).lower()


# -- the monthly ledger ----------------------------------------------------------------

def test_only_the_wanted_months_are_opened(spark, tmp_path):
    ledger = Tables(spark, SF001).ledger
    store = LedgerStore.create(ledger, str(tmp_path / "l"))
    target = store.target_window(LEDGER_WINDOW)
    assert "PartitionFilters: [isnotnull(ledger_month" in plan(target) and "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date" in plan(target)
    assert rows_of(target) == rows_of(A.target_window(C.dedup_exact(ledger), LEDGER_WINDOW))
    assert rows_of(store.observation(LEDGER_WINDOW)) == rows_of(A.observation(C.dedup_exact(ledger), LEDGER_WINDOW))
    months = {f.split("ledger_month=")[1].split("/")[0] for f in _scanned(target)}
    assert months == {"2001-07"}
    assert store.monthly_counts().collect() == C.monthly_counts(C.dedup_exact(ledger)).collect()
    assert "ReadSchema: struct<>" in plan(store.monthly_counts())


def _scanned(df):
    """The files that the scan opens after partition pruning."""
    return [r[0] for r in df.select(F.input_file_name()).distinct().collect()]


def test_append_equals_the_full_dedup(spark, tmp_path):
    day = dt.datetime
    old = [(1, day(2023, 1, 5), 1.0), (1, day(2023, 1, 5), 1.0), (2, day(2023, 2, 1), 2.0), (3, None, 3.0), (9, day(2022, 12, 31, 23, 59, 59), 9.0)]
    new = [(1, day(2023, 1, 5), 1.0), (1, day(2023, 1, 31, 23, 59), 1.0), (3, None, 3.0), (4, None, 4.0), (5, day(2023, 3, 1), 5.0), (5, day(2023, 3, 1), 5.0)]
    frame = lambda rows: spark.createDataFrame(rows, "customer_id long, date timestamp_ntz, amount double")
    store = LedgerStore.create(frame(old), str(tmp_path / "l"))
    untouched = {f for f in store.rows().inputFiles() if "2023-02" in f or "2022-12" in f}
    assert store.append(frame(new)) == ["2023-01", "2023-03", None]
    want = rows_of(C.dedup_exact(frame(old + new)))
    assert rows_of(store.rows()) == want
    assert untouched <= set(store.rows().inputFiles())  # other months keep their files
    store.append(frame(new))  # once more, as after a failure
    assert rows_of(store.rows()) == want
    assert store.append(frame(new).limit(0)) == []
    assert rows_of(store.rows(day(2023, 1, 5), day(2023, 1, 31))) == [(1, day(2023, 1, 5), 1.0)]


def test_empty_ledger(spark, tmp_path):
    empty = spark.createDataFrame([], "customer_id long, date timestamp_ntz, amount double")
    some = spark.createDataFrame([(1, dt.datetime(2023, 1, 1), 1.0)], empty.schema)
    store = LedgerStore.create(some, str(tmp_path / "l"))
    assert store.rows(dt.datetime(2024, 1, 1)).collect() == []


# -- bucketed tables --------------------------------------------------------------------

@pytest.fixture(scope="module")
def keyed(spark):
    t = Tables(spark, SF001)
    store = KeyedStore.create(t.profile, C.dedup_exact(t.ledger), buckets=5)
    yield store
    store.close()


def test_no_exchange_on_the_key(spark, keyed):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = LEDGER_WINDOW
        for df in (keyed.recency(w), keyed.frequency(w), keyed.average_value(w), keyed.rfm(w), keyed.label(w), keyed.rfm_with_label(w), keyed.model(w),
                   keyed.keys_in_both(), keyed.keys_without(), keyed.referential_integrity()):
            assert "hashpartitioning" not in plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_customer_days_equal_the_ledger(spark, keyed):
    t = Tables(spark, SF001)
    ledger = C.dedup_exact(t.ledger)
    w = LEDGER_WINDOW
    assert rows_of(keyed.rfm(w)) == rows_of(A.rfm_features(ledger, w))
    assert rows_of(keyed.label(w)) == rows_of(A.inactivity_label(ledger, w))
    assert rows_of(keyed.rfm_with_label(w)) == rows_of(A.rfm_with_label(ledger, w))
    assert rows_of(keyed.referential_integrity()) == rows_of(J.referential_integrity(t.profile, ledger))


def test_a_hot_customer_has_two_rows_a_day_at_most(spark):
    """Times of day, a cutoff at midnight, amounts that two decimals do not hold, null keys, dates and amounts."""
    w = StudyWindow("2024-01-24", "2024-01-20", "2024-01-25", "2024-01-27", days=(1, 3, 10))
    base = Tables(spark, SF001).ledger_intraday.withColumn("customer_id", F.when(F.col("customer_id") % 3 == 0, 1).otherwise(F.col("customer_id")))
    midnights = base.withColumn("date", F.date_trunc("day", "date").cast("timestamp_ntz"))
    odd = spark.createDataFrame([(None, dt.datetime(2024, 1, 2), 1.0, "a"), (77, None, 1.0, "a"), (78, dt.datetime(2024, 1, 23, 5), None, "a"),
                                 (79, dt.datetime(2024, 1, 22, 5), 0.125, "a"), (79, dt.datetime(2024, 1, 23, 5), 0.5, "a")], base.schema)
    ledger = base.unionByName(midnights).unionByName(odd)
    days = customer_days(ledger)
    assert days.groupBy("customer_id", "day").count().agg(F.max("count")).first()[0] <= 2
    profile = spark.createDataFrame([(1,), (77,), (None,), (5000,)], "customer_id long")
    store = KeyedStore.create(profile, ledger, buckets=3)
    assert rows_of(store.rfm(w)) == rows_of(A.rfm_features(ledger, w))
    assert rows_of(store.recency(w)) == rows_of(A.recency(ledger, w))
    assert rows_of(store.frequency(w)) == rows_of(A.frequency(ledger, w))
    assert rows_of(store.average_value(w)) == rows_of(A.average_value(ledger, w))
    assert rows_of(store.label(w)) == rows_of(A.inactivity_label(ledger, w))
    assert rows_of(store.keys_in_both()) == [(1,), (77,)] and rows_of(store.keys_without()) == [(5000,)]
    with pytest.raises(ValueError, match="no midnight"):
        store.rfm(StudyWindow("2024-01-24 12:00:00", "2024-01-20", "2024-01-25", "2024-01-27"))
    store.close()
