"""Profile and ledger bucketed by customer once, so that per-customer work needs no shuffle afterwards.

The ledger is not bucketed row by row: a customer with a third of all rows would
be one bucket file.  It is first reduced to customer-days (rows, sum of amounts,
last date per customer and day; rows at exactly midnight apart, as study bounds
are midnights and include both ends).  That reduction is combined in the tasks
before its one shuffle, and leaves a customer at most two rows per calendar day,
however many ledger rows it has.  Both tables are written with the same buckets
and sorted by key: the groupings of A1-A5 and A7, the merge of J2 and the key
sets of J4-J7 then run bucket by bucket, without an exchange on the key.

Tables are external (files under ``path``, by default a scratch folder) and
registered in the session catalog under names of their own; ``close`` drops the
names.  Windows whose bounds are not midnights raise: use the ledger itself.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from lapse.config import KEY_COL, LABEL_COL, StudyWindow
from lapse.operators import integrity
from lapse.operators.dataset import model_dataset
from lapse.operators.features import _feature_cols, whole_days
from lapse.session import scratch_folder


class KeyedStore:
    def __init__(self, profile: DataFrame, days: DataFrame, names: list[str], key: str, date: str):
        self.profile, self.days, self.names, self.key, self.date = profile, days, names, key, date

    @classmethod
    def create(cls, profile: DataFrame, ledger: DataFrame, buckets: int | None = None, path: str | None = None,
               key: str = KEY_COL, date: str = "date", amount: str = "amount") -> "KeyedStore":
        """Write both tables.  ``ledger`` is the clean ledger; ``buckets`` defaults to the session's shuffle partitions."""
        spark = ledger.sparkSession
        path = path or scratch_folder(spark, "keyed")
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        tag = uuid.uuid4().hex[:12]
        tables = {"profile": profile.filter(F.col(key).isNotNull()), "days": customer_days(ledger, key, date, amount)}
        names = []
        for stem, rows in tables.items():
            name = f"lapse_{stem}_{tag}"
            # One task and file per bucket, so that the files' sort order can be used.
            (rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
                 .option("path", f"{path}/{stem}").saveAsTable(name))
            names.append(name)
        return cls(spark.table(names[0]), spark.table(names[1]), names, key, date)

    def close(self) -> None:
        for name in self.names:
            self.days.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")

    # -- bounds on customer-days -------------------------------------------------

    def _midnight(self, value: dt.datetime) -> Column:
        if value.time() != dt.time(0):
            raise ValueError(f"customer-days cannot take the bound {value}: it is no midnight")
        return F.lit(value.date())

    def _from(self, value: dt.datetime) -> Column:
        return F.col("day") >= self._midnight(value)

    def _upto(self, value: dt.datetime) -> Column:
        day = self._midnight(value)
        return (F.col("day") < day) | ((F.col("day") == day) & F.col("at_midnight"))

    # -- features ------------------------------------------------------------------

    def _mean(self, rows: Column) -> Column:
        """Mean amount over the days where ``rows`` holds: exact if every value fits two decimals, as in ``exact_mean``."""
        def over(name: str) -> Column:
            return F.when(rows, F.col(name))
        total = F.when(F.coalesce(F.bool_and(over("fits")), F.lit(True)), F.sum(over("money")).cast("double")).otherwise(F.sum(over("plain")))
        n = F.sum(over("n_amounts"))
        return F.when(n > 0, total / n)

    def _aggregates(self, window: StudyWindow) -> list[Column]:
        seen = self._upto(window.cutoff)
        counts = [F.coalesce(F.sum(F.when(seen & self._from(window.window_start(d)), F.col("n"))), F.lit(0)).alias(window.freq_col(d))
                  for d in reversed(window.days)]
        return [F.max(F.when(seen, F.col("last"))).alias("_last"), *counts,
                self._mean(seen & self._from(window.window_start(window.widest))).alias("_value")]

    def recency(self, window: StudyWindow) -> DataFrame:
        last = self.days.filter(self._upto(window.cutoff)).groupBy(self.key).agg(F.max("last").alias("last_tx_date"))
        return last.select(self.key, "last_tx_date", whole_days(last, "last_tx_date", F.col("last_tx_date"), window.cutoff).alias("recency_days"))

    def _recent(self, window: StudyWindow) -> DataFrame:
        return self.days.filter(self._upto(window.cutoff) & self._from(window.window_start(window.widest)))

    def frequency(self, window: StudyWindow) -> DataFrame:
        return self._recent(window).groupBy(self.key).agg(*self._aggregates(window)[1:-1])

    def average_value(self, window: StudyWindow) -> DataFrame:
        return self._recent(window).groupBy(self.key).agg(self._mean(F.lit(True)).alias(window.value_col))

    def _features(self, grouped: DataFrame, window: StudyWindow) -> list[Column]:
        return _feature_cols(grouped.withColumnRenamed("_last", self.date), window, self.key, self.date)

    def rfm(self, window: StudyWindow) -> DataFrame:
        grouped = self.days.filter(self._upto(window.cutoff)).groupBy(self.key).agg(*self._aggregates(window))
        return grouped.select(*self._features(grouped, window))

    def _presence(self, window: StudyWindow) -> tuple[Column, Column]:
        return (self._from(window.pop_start) & self._upto(window.cutoff)), (self._from(window.target_lo) & self._upto(window.target_hi))

    def label(self, window: StudyWindow, label: str = LABEL_COL) -> DataFrame:
        pop, target = self._presence(window)
        flags = self.days.filter(pop | target).groupBy(self.key).agg(F.max(pop.cast("int")).alias("_pop"), F.max(target.cast("int")).alias("_tgt"))
        return flags.filter("_pop = 1").select(self.key, (F.lit(1) - F.col("_tgt")).cast("int").alias(label))

    def rfm_with_label(self, window: StudyWindow, label: str = LABEL_COL) -> DataFrame:
        """Features and label of the population from one grouping."""
        pop, target = self._presence(window)
        rows = self.days.filter(self._upto(window.target_hi))
        grouped = rows.groupBy(self.key).agg(*self._aggregates(window), F.max(pop.cast("int")).alias("_pop"), F.max(target.cast("int")).alias("_tgt"))
        return grouped.filter("_pop = 1").select(*self._features(grouped, window), (F.lit(1) - F.col("_tgt")).cast("int").alias(label))

    def model(self, window: StudyWindow, exclude: Sequence[str] = ()) -> DataFrame:
        return model_dataset(self.profile, self.rfm_with_label(window), key=self.key, exclude=exclude)

    # -- key sets -------------------------------------------------------------------

    def referential_integrity(self) -> DataFrame:
        return integrity.referential_integrity(self.profile, self.days, self.key, self.key)

    def _matched(self, how: str) -> DataFrame:
        # The stored keys are never null, so a plain equality keeps the buckets (a set operation compares null-safely).
        return self.profile.select(self.key).distinct().join(self.days.select(self.key).distinct(), self.key, how)

    def keys_in_both(self) -> DataFrame:
        return self._matched("left_semi")

    def keys_without(self) -> DataFrame:
        return self._matched("left_anti")


def customer_days(ledger: DataFrame, key: str = KEY_COL, date: str = "date", amount: str = "amount") -> DataFrame:
    """(key, day, at_midnight, n, last, n_amounts, money, fits, plain): at most two rows per customer and day.

    Rows without a date keep their customer (day and last are null): the key sets need it.
    """
    when = F.col(date)
    day = F.to_date(when)
    midnight = F.lit(True) if isinstance(ledger.schema[date].dataType, DateType) else when == day.cast(ledger.schema[date].dataType)
    value = F.col(amount)
    money = value.try_cast("decimal(18,2)")
    return (ledger.filter(F.col(key).isNotNull())
                  .groupBy(F.col(key).alias(key), day.alias("day"), midnight.alias("at_midnight"))
                  .agg(F.count(F.lit(1)).alias("n"), F.max(when).alias("last"), F.count(value).alias("n_amounts"),
                       F.sum(money).alias("money"), F.bool_and(F.coalesce(money.cast("double") == value.cast("double"), value.isNull())).alias("fits"),
                       F.sum(value.cast("double")).alias("plain")))
