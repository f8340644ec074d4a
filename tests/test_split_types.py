"""The split's boundary rows stay in Spark: any key type, any zone of the Python process."""

import os
import time

import pytest
from pyspark.sql import functions as F

from lapse.operators import dataset as D


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def process_zone(request):
    before = os.environ.get("TZ")
    os.environ["TZ"] = request.param
    time.tzset()
    yield request.param
    if before is None:
        del os.environ["TZ"]
    else:
        os.environ["TZ"] = before
    time.tzset()


KEYS = {
    "timestamp_ntz": "TIMESTAMP_NTZ '2023-03-11 20:00:00.123456' + make_dt_interval(0, id)",
    "timestamp": "TIMESTAMP '2023-03-11 20:00:00.123456Z' + make_dt_interval(0, id)",
    "date": "date_add(DATE '1969-12-01', id)",
    "decimal": "CAST(id AS DECIMAL(38, 10)) / 3",
    "binary": "CAST(lpad(CAST(id AS STRING), 4, '0') AS BINARY)",
    "string": "lpad(CAST(id AS STRING), 4, '0')",
    "double": "CAST(id AS DOUBLE) / 7",
}


@pytest.mark.parametrize("kind", KEYS)
def test_order_and_tie_keys_of_any_type(spark, process_zone, kind):
    rows = spark.range(100).selectExpr("CAST(id AS INT) AS id").selectExpr("id", f"{KEYS[kind]} AS k").repartition(4)
    by_order = D.ordered_split(rows, "k", "id", rows_per_block=9)
    by_tie = D.ordered_split(rows.withColumn("same", F.lit(1)), "same", "k", rows_per_block=9)
    for split in (by_order, by_tie):
        got = {r["id"]: r["split"] for r in split.collect()}
        assert got == {i: "train" if i < 70 else "validation" if i < 85 else "test" for i in range(100)}


def test_null_order_values_last_and_null_ties_first(spark):
    rows = [(None, None)] + [(1, f"t{i:02d}") for i in range(9)] + [(1, None)] + [(None, f"u{i}") for i in range(9)]
    df = spark.createDataFrame(rows, "o int, t string")
    got = [(r["o"], r["t"], r["split"]) for r in D.ordered_split(df, "o", "t", rows_per_block=2).collect()]
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    want = [(*r, "train" if i < 14 else "validation" if i < 17 else "test") for i, r in enumerate(want)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_few_rows_and_none(spark):
    one = spark.createDataFrame([(1, 1)], "o int, t int")
    assert [r["split"] for r in D.ordered_split(one, "o", "t").collect()] == ["test"]
    assert D.ordered_split(one.limit(0), "o", "t").collect() == []


def test_many_rows_of_one_order_value_and_equal_ties(spark):
    """A part that ranging cannot make smaller ends the narrowing."""
    df = spark.range(500).select(F.lit(3).alias("o"), F.lit("x").alias("t"))
    got = D.ordered_split(df, "o", "t", rows_per_block=10)
    assert got.count() == 500  # all rows are equal to both boundary rows: none sorts before them
    assert [r["split"] for r in got.select("split").distinct().collect()] == ["test"]


def test_encoder_without_any_listed_column(spark):
    df = spark.createDataFrame([(1,)], "other int")
    classes = D.fit_encoder(df, ["location", "gender"])
    assert classes.columns == ["column_name", "value", "code"] and classes.collect() == []
    assert D.apply_encoder(df, classes, ["location"]).collect() == df.collect()
    assert D.unseen_counts(df, classes, ["location"]).collect() == []


def test_encoder_of_an_empty_training_part(spark):
    df = spark.createDataFrame([("a",)], "location string")
    classes = D.fit_encoder(df.limit(0), ["location"])
    assert classes.collect() == []
    assert [r["location_enc"] for r in D.apply_encoder(df, classes, ["location"]).collect()] == [0]


def test_stored_encoder_gives_equal_codes(spark, tmp_path):
    train = spark.createDataFrame([(c, i % 2 == 0) for i, c in enumerate("dbcab")] + [(None, None)], "location string, gender boolean")
    new = spark.createDataFrame([("a", True), ("z", False), ("z", None), (None, True)], "location string, gender boolean")
    cols = ["location", "gender", "absent"]
    classes = D.fit_encoder(train, cols)
    D.save_encoder(classes, str(tmp_path / "enc"), 1)
    D.save_encoder(D.fit_encoder(train.filter("location <> 'a'"), cols), str(tmp_path / "enc"), 2)
    first = D.load_encoder(spark, str(tmp_path / "enc"), 1)
    assert sorted(first.collect()) == sorted(classes.collect())
    assert sorted(D.apply_encoder(new, first, cols, frozen=True).collect(), key=str) == sorted(D.apply_encoder(new, classes, cols).collect(), key=str)
    unseen = {r["column_name"]: (r["n_rows"], r["n_unseen"], r["unseen_pct"]) for r in D.unseen_counts(new, first, cols, frozen=True).collect()}
    assert unseen == {"location": (4, 2, 50.0), "gender": (4, 0, 0.0)}
    latest = D.load_encoder(spark, str(tmp_path / "enc"))
    assert ("location", "a") not in {(r["column_name"], r["value"]) for r in latest.collect()}
    with pytest.raises(Exception, match="already exists"):
        D.save_encoder(classes, str(tmp_path / "enc"), 2)


def test_class_table_is_read_without_shuffle(spark):
    df = spark.createDataFrame([(f"v{i}",) for i in range(50)], "location string")
    plan = D.fit_encoder(df, ["location"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
