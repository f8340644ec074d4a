"""End to end: CSV profile + CSV ledger -> every output table written."""

import os
import tempfile

from pyspark.sql import functions as F

from lapse.config import LEDGER_WINDOW
from lapse.plans.catalog import PROFILE_EXCLUDE
from lapse.plans.report import study_outputs, write_outputs
from lapse.sources import econ_dimension, parse_dates, read_table
from lapse.sources.views import PROFILE_SEGMENT_ORDER, Tables
from tests.conftest import SF001


def test_study_from_csv_writes_every_output(spark):
    t = Tables(spark, SF001)
    root = tempfile.mkdtemp(prefix="lapse-report-")
    prof_path, led_path = os.path.join(root, "profile"), os.path.join(root, "ledger")
    (t.profile.withColumn("first_tx", F.col("first_tx").cast("string"))
              .withColumn("last_tx", F.col("last_tx").cast("string"))
              .write.option("header", "true").csv(prof_path))
    t.ledger.withColumn("date", F.date_format("date", "yyyy-MM-dd")).write.option("header", "true").csv(led_path)

    profile = read_table(spark, prof_path, "csv")
    ledger = parse_dates(read_table(spark, led_path, "csv"), "date")
    outs = study_outputs(profile, ledger, econ_dimension(spark, "2000-01-01"), LEDGER_WINDOW,
                         PROFILE_SEGMENT_ORDER, exclude=PROFILE_EXCLUDE)
    written = write_outputs(outs, os.path.join(root, "out"))
    assert set(written) == set(outs)
    enc = spark.read.parquet(os.path.join(root, "out", "encoded_dataset"))
    assert set(r.split for r in enc.select("split").distinct().collect()) == {"train", "validation", "test"}
    # same model population as the parquet-based pipeline
    from lapse.plans.catalog import study
    assert enc.count() == study(spark, SF001).model.count()


def test_cli_runs_the_study(spark):
    from lapse.__main__ import main
    t = Tables(spark, SF001)
    root = tempfile.mkdtemp(prefix="lapse-cli-")
    t.profile.write.parquet(os.path.join(root, "profile"))
    t.ledger.write.parquet(os.path.join(root, "ledger"))
    out = os.path.join(root, "out")
    main(["--profile", os.path.join(root, "profile"), "--ledger", os.path.join(root, "ledger"), "--out", out,
          "--format", "parquet", "--cutoff", "2001-06-30", "--pop-start", "2001-05-01",
          "--target", "2001-07-01", "2001-07-29", "--econ-start", "2000-01-01",
          "--segments", *PROFILE_SEGMENT_ORDER])
    assert spark.read.parquet(os.path.join(out, "model_dataset")).count() == 87
    assert spark.read.parquet(os.path.join(out, "strongest_month")).count() == 1


def test_cli_keeps_rejected_rows_and_the_encoder(spark):
    from lapse.__main__ import main
    from lapse.operators.dataset import load_encoder
    t = Tables(spark, SF001)
    root = tempfile.mkdtemp(prefix="lapse-cli-")
    profile, ledger, out = (os.path.join(root, n) for n in ("profile", "ledger", "out"))
    t.profile.write.option("header", "true").csv(profile)
    t.ledger.withColumn("date", F.date_format("date", "yyyy-MM-dd")).coalesce(1).write.option("header", "true").csv(ledger)
    with open(os.path.join(ledger, "more.csv"), "w") as f:
        f.write("customer_id,date,amount,type\n1,2001-02-30,5.0,A\nx,2001-02-03,5.0,A\n2,2001-02-03\n")
    main(["--profile", profile, "--ledger", ledger, "--out", out, "--cutoff", "2001-06-30", "--pop-start", "2001-05-01",
          "--target", "2001-07-01", "2001-07-29", "--econ-start", "2000-01-01", "--segments", *PROFILE_SEGMENT_ORDER,
          "--ledger-schema", "customer_id bigint, date string, amount double, type string", "--encoder-version", "3"])
    rejected = {(r["reason"], r["raw"]) for r in spark.read.parquet(os.path.join(out, "rejected_ledger")).collect()}
    assert rejected == {("date: date", "1,2001-02-30,5.0,A"), ("malformed", "x,2001-02-03,5.0,A"), ("malformed", "2,2001-02-03")}
    assert spark.read.parquet(os.path.join(out, "rejected_profile")).count() == 0
    assert spark.read.parquet(os.path.join(out, "model_dataset")).count() == 87
    stored = load_encoder(spark, os.path.join(out, "encoders"))
    assert sorted(stored.collect()) == sorted(spark.read.parquet(os.path.join(out, "encoder_classes")).collect())
