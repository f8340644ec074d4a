"""A clean ledger on disk, one folder per calendar month, kept free of exact copies as new files arrive.

``create`` writes the deduplicated ledger partitioned by the month of its date.
Rows of a date range are read with a partition filter beside the date filter, so
the scan opens the wanted months only.  ``append`` brings in a new file: exact
copies have equal dates, so only the months that the new rows touch are read,
merged, deduplicated and replaced (dynamic partition overwrite); the rest of the
ledger is not read.  A failed append can be run again: its rows are merged like
any copies.

Rows without a date live in the null month.  A month may hold a third of all
rows: files are cut by size (a rebalance of the months), not one per month.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.config import StudyWindow
from lapse.functions.columns import bound
from lapse.functions.materialize import freeze
from lapse.operators.cleaning import dedup_exact
from lapse.operators.features import observation, target_window, window_counts

MONTH = "ledger_month"


class LedgerStore:
    def __init__(self, spark: SparkSession, path: str, date: str = "date"):
        self.spark = spark
        self.path = path.rstrip("/")
        self.date = date

    @classmethod
    def create(cls, ledger: DataFrame, path: str, date: str = "date") -> "LedgerStore":
        store = cls(ledger.sparkSession, path, date)
        store._write(dedup_exact(store._with_month(ledger)), "errorifexists")
        return store

    # -- writing --------------------------------------------------------------

    def _with_month(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(MONTH, F.date_format(F.col(self.date), "yyyy-MM"))

    def _write(self, rows: DataFrame, mode: str) -> None:
        (rows.hint("rebalance", F.col(MONTH)).write.mode(mode).option("partitionOverwriteMode", "dynamic")
             .partitionBy(MONTH).parquet(self.path))

    def append(self, rows: DataFrame) -> list[str | None]:
        """Add the rows of a new file that the ledger does not hold yet; returns the months rewritten."""
        stored = self._all()
        new = freeze(dedup_exact(self._with_month(rows.select(*[c for c in stored.columns if c != MONTH]))))
        months = [r[0] for r in new.select(MONTH).distinct().collect()]  # one row per calendar month of the file
        if not months:
            return []
        touched = F.col(MONTH).isin([m for m in months if m is not None])
        if None in months:
            touched = F.coalesce(touched, F.lit(True))
        merged = dedup_exact(stored.filter(touched).unionByName(new))
        # The months are replaced from a written table: a retried task never reads a half-replaced month.
        self._write(freeze(merged), "overwrite")
        return sorted(months, key=lambda m: (m is None, m or ""))

    # -- reading --------------------------------------------------------------

    def _all(self) -> DataFrame:
        # The partition value stays text: "2001-07" is no date to infer.
        files = self.spark.read.parquet(self.path)
        return files.withColumn(MONTH, F.col(MONTH).cast("string"))

    def _months(self, lo: dt.datetime | None, hi: dt.datetime | None) -> Column:
        keep = F.lit(True)
        if lo is not None:
            keep = keep & (F.col(MONTH) >= lo.strftime("%Y-%m"))
        if hi is not None:
            keep = keep & (F.col(MONTH) <= hi.strftime("%Y-%m"))
        return keep

    def rows(self, lo: dt.datetime | None = None, hi: dt.datetime | None = None) -> DataFrame:
        """Rows with ``lo <= date <= hi``; without bounds all rows, those without a date included."""
        out = self._all().filter(self._months(lo, hi)) if lo is not None or hi is not None else self._all()
        if lo is not None:
            out = out.filter(F.col(self.date) >= bound(out, self.date, lo))
        if hi is not None:
            out = out.filter(F.col(self.date) <= bound(out, self.date, hi))
        return out.drop(MONTH)

    def observation(self, window: StudyWindow) -> DataFrame:
        return observation(self.rows(hi=window.cutoff), window, self.date)

    def target_window(self, window: StudyWindow) -> DataFrame:
        return target_window(self.rows(window.target_lo, window.target_hi), window, self.date)

    def window_counts(self, window: StudyWindow) -> DataFrame:
        """Nothing after the target window is opened."""
        return window_counts(self.rows(hi=window.target_hi), window, self.date)

    def monthly_counts(self) -> DataFrame:
        """Rows per month from the partition values alone: no data column is read."""
        counts = self._all().groupBy(MONTH).agg(F.count(F.lit(1)).alias("n_rows"))
        return counts.select(F.to_date(F.concat(F.col(MONTH), F.lit("-01"))).alias("month"), "n_rows").orderBy("month")

    def daily_volume(self, lo: dt.datetime | None = None, hi: dt.datetime | None = None) -> DataFrame:
        """Rows per day of a range (days with data only)."""
        return (self.rows(lo, hi).groupBy(F.to_date(F.col(self.date)).alias("date"))
                    .agg(F.count(F.lit(1)).alias("n_transactions")).orderBy("date"))
