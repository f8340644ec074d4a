"""Readers: CSV with inference and with a schema, NaN handling, dates, econ."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from lapse.operators import profiling as P
from lapse.sources import econ_dimension, parse_dates, read_table
from lapse.sources.readers import LEDGER_SCHEMA
from lapse.sources.views import Tables
from tests.conftest import SF001


def test_csv_roundtrip_of_the_ledger(spark):
    ledger = Tables(spark, SF001).ledger
    out = tempfile.mkdtemp(prefix="lapse-csv-")
    path = os.path.join(out, "tx")
    (ledger.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
           .write.option("header", "true").csv(path))
    inferred = read_table(spark, path, "csv")
    assert inferred.count() == ledger.count()
    assert dict(inferred.dtypes)["date"] == "date"
    typed = parse_dates(read_table(spark, path, "csv", schema=LEDGER_SCHEMA), "date")
    assert dict(typed.dtypes)["date"] == "timestamp_ntz"
    assert typed.agg(F.sum("amount")).first()[0] == ledger.agg(F.sum("amount")).first()[0]


def test_econ_dimension_months(spark):
    rows = econ_dimension(spark, "2023-01-01").orderBy("month").collect()
    assert len(rows) == 12
    assert rows[0].month == dt.date(2023, 1, 1) and rows[-1].month == dt.date(2023, 12, 1)
    assert min(rows, key=lambda r: r.cop_usd_rate).month == dt.date(2023, 7, 1)


def test_source_summary_total(spark):
    t = Tables(spark, SF001)
    rows = {r.source: r for r in P.source_summary({"profile": t.profile, "ledger": t.ledger}).collect()}
    assert rows["total"].n_rows == rows["profile"].n_rows + rows["ledger"].n_rows
    assert rows["total"].n_cols is None and rows["ledger"].n_cols == 4


def test_preview_is_ordered_and_limited(spark):
    rows = P.preview(Tables(spark, SF001).ledger, 5).collect()
    assert len(rows) == 5 and rows == sorted(rows, key=lambda r: tuple(r))
