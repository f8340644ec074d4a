"""The streaming ledger job equals the batch operators on finalized days."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from lapse.operators import cleaning as C
from lapse.operators import summaries as S
from lapse.sources.views import Tables
from lapse.streaming import dedup_stream, read_ledger_stream, start_sink, volume_stream
from tests.conftest import SF001


def test_stream_daily_volume_matches_batch(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ledger = Tables(spark, SF001).ledger_intraday
    root = tempfile.mkdtemp(prefix="lapse-stream-")
    src = os.path.join(root, "in")
    # three batches of files, the second repeating rows of the first (duplicates)
    first = ledger.filter(F.col("date") < F.lit(dt.datetime(2024, 1, 10)))
    first.write.parquet(os.path.join(src, "b1"))
    first.limit(50).write.parquet(os.path.join(src, "b2"))
    ledger.filter(F.col("date") >= F.lit(dt.datetime(2024, 1, 10))).write.parquet(os.path.join(src, "b3"))

    stream = read_ledger_stream(spark, src, ledger.schema, recursiveFileLookup="true")
    q = start_sink(volume_stream(dedup_stream(stream, watermark="1 day")),
                   os.path.join(root, "out"), os.path.join(root, "ckpt"), available_now=True)
    q.awaitTermination(300)
    got = {r.date: r.n_transactions for r in spark.read.parquet(os.path.join(root, "out")).collect()}
    exp = {r.date: r.n_transactions for r in S.daily_volume(C.dedup_exact(ledger)).collect()}
    # days the watermark has closed are exact; the open tail is still in state
    assert got and all(got[d] == exp[d] for d in got)
    assert max(got) >= max(exp) - dt.timedelta(days=3)


def test_stream_resumes_from_checkpoint_exactly_once(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ledger = Tables(spark, SF001).ledger_intraday
    root = tempfile.mkdtemp(prefix="lapse-stream-")
    src, out, ckpt = (os.path.join(root, x) for x in ("in", "out", "ckpt"))
    cut = F.lit(dt.datetime(2024, 1, 15))
    ledger.filter(F.col("date") < cut).write.parquet(os.path.join(src, "b1"))

    def run():
        stream = read_ledger_stream(spark, src, ledger.schema, recursiveFileLookup="true")
        q = start_sink(volume_stream(dedup_stream(stream, watermark="1 day")), out, ckpt, available_now=True)
        q.awaitTermination(300)

    run()
    first = spark.read.parquet(out).count()
    # a restart (same checkpoint) after more files, one of them repeating old rows
    ledger.filter(F.col("date") >= cut).write.parquet(os.path.join(src, "b2"))
    ledger.filter(F.col("date") < cut).limit(20).write.parquet(os.path.join(src, "b3"))
    run()
    rows = spark.read.parquet(out).collect()
    days = [r.date for r in rows]
    assert len(days) == len(set(days)) > first  # each closed day written once
    exp = {r.date: r.n_transactions for r in S.daily_volume(C.dedup_exact(ledger)).collect()}
    assert all(r.n_transactions == exp[r.date] for r in rows)


def test_stream_dedup_merges_a_flood_of_copies(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ledger = Tables(spark, SF001).ledger_intraday
    root = tempfile.mkdtemp(prefix="lapse-stream-")
    src = os.path.join(root, "in")
    ledger.write.parquet(os.path.join(src, "b1"))
    first = ledger.orderBy(*ledger.columns).limit(1)
    first.select("*", F.explode(F.sequence(F.lit(1), F.lit(3000))).alias("_k")).drop("_k") \
         .write.parquet(os.path.join(src, "b2"))
    stream = read_ledger_stream(spark, src, ledger.schema, recursiveFileLookup="true")
    q = start_sink(volume_stream(dedup_stream(stream, watermark="1 day", combine_in_tasks=True)),
                   os.path.join(root, "out"), os.path.join(root, "ckpt"), available_now=True)
    q.awaitTermination(300)
    got = {r.date: r.n_transactions for r in spark.read.parquet(os.path.join(root, "out")).collect()}
    exp = {r.date: r.n_transactions for r in S.daily_volume(C.dedup_exact(ledger)).collect()}
    assert got and all(got[d] == exp[d] for d in got)
