"""Run the whole study from a profile CSV and a ledger CSV; write every output.

CSV rows that do not fit their schema, and ledger rows whose date is no date, are
written as ``rejected_profile`` and ``rejected_ledger`` with their reasons.

    python -m lapse --profile customer_data.csv --ledger transactions_data.csv \\
        --out /shared/study_out [--cutoff 2023-11-30 --pop-start 2023-10-01 \\
        --target 2023-12-01 2023-12-29 --econ-start 2023-01-01]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from lapse.config import REFERENCE_WINDOW, StudyWindow
from lapse.operators.dataset import save_encoder
from lapse.plans.report import study_outputs, write_outputs
from lapse.sources import econ_dimension, parse_dates, read_table
from lapse.sources.rejects import read_with_rejects
from lapse.sources.views import SEGMENT_ORDER


def main(argv=None):
    ap = argparse.ArgumentParser(prog="lapse")
    ap.add_argument("--profile", required=True)
    ap.add_argument("--ledger", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--cutoff", default=REFERENCE_WINDOW.cutoff.date().isoformat())
    ap.add_argument("--pop-start", default=REFERENCE_WINDOW.pop_start.date().isoformat())
    ap.add_argument("--target", nargs=2, default=[REFERENCE_WINDOW.target_lo.date().isoformat(),
                                                  REFERENCE_WINDOW.target_hi.date().isoformat()])
    ap.add_argument("--econ-start", default="2023-01-01")
    ap.add_argument("--segments", nargs="+", default=SEGMENT_ORDER)
    ap.add_argument("--profile-schema", help="columns and types as DDL; without it a CSV is read once more to infer them")
    ap.add_argument("--ledger-schema", help="the same for the ledger")
    ap.add_argument("--work-dir", help="shared folder for intermediate tables, where spark.checkpoint.dir is unset")
    ap.add_argument("--encoder-version", type=int, help="keep the fitted label encoder as this version in OUT/encoders")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("lapse-study").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # results must not follow the machine's zone
    if args.work_dir and not (spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)):
        spark.sparkContext.setCheckpointDir(args.work_dir)
    window = StudyWindow(cutoff=args.cutoff, pop_start=args.pop_start,
                         target_lo=args.target[0], target_hi=args.target[1])
    profile, profile_rejects = read_input(spark, args.profile, args.format, args.profile_schema)
    ledger, ledger_rejects = read_input(spark, args.ledger, args.format, args.ledger_schema, {"date": None})
    outputs = study_outputs(profile, parse_dates(ledger, "date"), econ_dimension(spark, args.econ_start), window, args.segments)
    rejects = {"rejected_profile": profile_rejects, "rejected_ledger": ledger_rejects}
    outputs |= {name: rows for name, rows in rejects.items() if rows is not None}
    for name in write_outputs(outputs, args.out):
        print(name)
    if args.encoder_version is not None:
        save_encoder(outputs["encoder_classes"], f"{args.out.rstrip('/')}/encoders", args.encoder_version)


def read_input(spark: SparkSession, path: str, fmt: str, schema: str | None, dates: dict | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The rows that fit and, for CSV, those that do not.  Without a schema the types are inferred first."""
    if fmt != "csv":
        return read_table(spark, path, fmt, schema), None
    return read_with_rejects(spark, path, schema or read_table(spark, path, fmt, nan_as_null=False).schema, dates)


if __name__ == "__main__":
    main()
