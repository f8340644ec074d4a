"""Time partition, RFM features and the forward-looking inactivity label.

All features of one customer come out of a single conditional aggregation
over the observation rows: one shuffle of partial aggregates keyed by
customer, instead of five grouped frames merged by four joins.  Partial
(map-side) aggregation collapses a hot customer to one row per input
partition before the exchange, so a customer holding a third of the ledger
does not load one reducer.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType

from lapse.config import KEY_COL, LABEL_COL, StudyWindow
from lapse.functions.columns import bound
from lapse.functions.numeric import exact_mean, half_even, q, sql_literal


def observation(ledger: DataFrame, window: StudyWindow, date: str = "date") -> DataFrame:
    """Rows with ``date <= cutoff`` (intraday rows after a midnight cutoff are out)."""
    return ledger.filter(F.col(date) <= bound(ledger, date, window.cutoff))


def target_window(ledger: DataFrame, window: StudyWindow, date: str = "date") -> DataFrame:
    """Rows with ``target_lo <= date <= target_hi``."""
    d = F.col(date)
    return ledger.filter((d >= bound(ledger, date, window.target_lo)) &
                         (d <= bound(ledger, date, window.target_hi)))


def window_counts(ledger: DataFrame, window: StudyWindow, date: str = "date") -> DataFrame:
    """Row counts of the observation set and of the target window, one pass."""
    d = F.col(date)
    in_obs = d <= bound(ledger, date, window.cutoff)
    in_tgt = (d >= bound(ledger, date, window.target_lo)) & (d <= bound(ledger, date, window.target_hi))
    return ledger.agg(F.count_if(in_obs).alias("n_observation"),
                      F.count_if(in_tgt).alias("n_target"))


def whole_days(ledger: DataFrame, date: str, start: Column, end: dt.datetime) -> Column:
    """Complete 24-hour blocks from ``start`` to ``end`` (``end >= start``).

    For ``timestamp_ntz`` and ``date`` columns this is computed without any
    time zone: calendar days between the two dates, minus one when the start's
    time of day is later than the end's, so a DST change in the session zone
    cannot shift it.  Zoned timestamps use ``timestamp_diff`` in the session zone.
    """
    dtype = ledger.schema[date].dataType
    if isinstance(dtype, (TimestampNTZType, DateType)):
        def tod(c):
            return F.hour(c) * 3600 + F.minute(c) * 60 + F.date_part(F.lit("SECOND"), c)
        end_lit = bound(ledger, date, end)
        days = F.datediff(F.to_date(end_lit), F.to_date(start))
        if isinstance(dtype, DateType):
            return days.cast("bigint")
        return (days - F.when(tod(start) > tod(end_lit), 1).otherwise(0)).cast("bigint")
    return F.timestamp_diff("DAY", start, bound(ledger, date, end))


def _in_window(ledger: DataFrame, window: StudyWindow, days: int, date: str) -> Column:
    return F.col(date) >= bound(ledger, date, window.window_start(days))


def _observed(ledger: DataFrame, window: StudyWindow, key: str, date: str) -> DataFrame:
    return observation(ledger, window, date).filter(F.col(key).isNotNull())


def recency(ledger: DataFrame, window: StudyWindow, key: str = KEY_COL,
            date: str = "date") -> DataFrame:
    """Last observed date per customer and whole 24-hour days from it to the cutoff."""
    last = _observed(ledger, window, key, date).groupBy(key).agg(F.max(date).alias("last_tx_date"))
    return last.select(key, "last_tx_date",
                       whole_days(ledger, date, F.col("last_tx_date"), window.cutoff).alias("recency_days"))


def frequency(ledger: DataFrame, window: StudyWindow, key: str = KEY_COL,
              date: str = "date") -> DataFrame:
    """Row counts per customer in each trailing window (both ends inclusive).

    One row per customer with at least one row in the widest window.
    """
    rows = _observed(ledger, window, key, date).filter(_in_window(ledger, window, window.widest, date))
    aggs = [F.count_if(_in_window(ledger, window, d, date)).alias(window.freq_col(d))
            for d in reversed(window.days)]
    return rows.groupBy(key).agg(*aggs)


def average_value(ledger: DataFrame, window: StudyWindow, key: str = KEY_COL,
                  date: str = "date", amount: str = "amount") -> DataFrame:
    """Exact mean amount per customer over the widest trailing window."""
    rows = _observed(ledger, window, key, date).filter(_in_window(ledger, window, window.widest, date))
    return rows.groupBy(key).agg(exact_mean(F.col(amount)).alias(window.value_col))


def change_col(window: StudyWindow) -> str:
    return f"freq_{window.days[-2]}d_change"


def _feature_cols(ledger: DataFrame, window: StudyWindow, key: str, date: str) -> list[Column]:
    """Final feature columns from the aggregated ``_last``, ``freq_*`` and
    ``_value``: whole-day recency, counts, mean value (0 when no row in the
    widest window) and the rate of change (f_mid - f_wide/k) / (f_wide/k + 1)
    at 4 dp, with k = wide / mid (90 / 30 = 3), in the formula's own order."""
    wide, mid = window.widest, window.days[-2]
    k = F.lit(float(wide) / float(mid))
    f_wide = F.col(window.freq_col(wide)).cast("double")
    f_mid = F.col(window.freq_col(mid)).cast("double")
    change = (f_mid - f_wide / k) / (f_wide / k + F.lit(1.0))
    return [
        F.col(key),
        whole_days(ledger, date, F.col("_last"), window.cutoff).alias("recency_days"),
        *[F.col(c) for c in window.freq_cols],
        F.coalesce(F.col("_value"), F.lit(0.0)).alias(window.value_col),
        half_even(change, 4).alias(change_col(window)),
    ]


def rfm_features(ledger: DataFrame, window: StudyWindow, key: str = KEY_COL,
                 date: str = "date", amount: str = "amount") -> DataFrame:
    """One row per observed customer: recency, trailing frequencies, mean value
    and rate of change (see ``_feature_cols``).  Customers without rows in a
    window get 0 for it.
    """
    wide = window.widest
    in_wide = _in_window(ledger, window, wide, date)
    aggs = [F.max(date).alias("_last")]
    aggs += [F.count_if(_in_window(ledger, window, d, date)).alias(window.freq_col(d))
             for d in reversed(window.days)]
    aggs.append(exact_mean(F.when(in_wide, F.col(amount))).alias("_value"))
    g = _observed(ledger, window, key, date).groupBy(key).agg(*aggs)
    return g.select(*_feature_cols(ledger, window, key, date))


def inactivity_label(ledger: DataFrame, window: StudyWindow, key: str = KEY_COL,
                     date: str = "date", label: str = LABEL_COL) -> DataFrame:
    """Population: customers with a row in ``[pop_start, cutoff]``.
    Label 1 when such a customer has no row in ``[target_lo, target_hi]``.

    One grouped pass with two presence flags (no key sets on the driver); the
    OR of the two ranges is pushed into the scan.
    """
    d = F.col(date)
    in_pop = (d >= bound(ledger, date, window.pop_start)) & (d <= bound(ledger, date, window.cutoff))
    in_tgt = (d >= bound(ledger, date, window.target_lo)) & (d <= bound(ledger, date, window.target_hi))
    flags = (ledger.filter(F.col(key).isNotNull() & (in_pop | in_tgt))
                   .groupBy(key)
                   .agg(F.max(in_pop.cast("int")).alias("_pop"), F.max(in_tgt.cast("int")).alias("_tgt")))
    return flags.filter(F.col("_pop") == 1).select(key, (F.lit(1) - F.col("_tgt")).cast("int").alias(label))


def rfm_with_label(ledger: DataFrame, window: StudyWindow, key: str = KEY_COL, date: str = "date",
                   amount: str = "amount", label: str = LABEL_COL) -> DataFrame:
    """Features and label of the population in one pass over the ledger.

    Equal to ``rfm_features`` inner-joined with ``inactivity_label`` (every
    population member is observed), but the ledger is scanned once, with one
    pushed bound ``date <= target_hi``, and aggregated by customer once: no
    second scan, no second shuffle, no join between the two.
    """
    d = F.col(date)
    cut = bound(ledger, date, window.cutoff)
    obs = d <= cut
    in_pop = (d >= bound(ledger, date, window.pop_start)) & obs
    in_tgt = (d >= bound(ledger, date, window.target_lo)) & (d <= bound(ledger, date, window.target_hi))
    wide = window.widest
    aggs = [F.max(F.when(obs, d)).alias("_last")]
    aggs += [F.count_if(obs & _in_window(ledger, window, n, date)).alias(window.freq_col(n))
             for n in reversed(window.days)]
    aggs.append(exact_mean(F.when(obs & _in_window(ledger, window, wide, date), F.col(amount))).alias("_value"))
    aggs += [F.max(in_pop.cast("int")).alias("_pop"), F.max(in_tgt.cast("int")).alias("_tgt")]
    rows = ledger.filter(F.col(key).isNotNull() & (d <= bound(ledger, date, window.target_hi)))
    g = rows.groupBy(key).agg(*aggs).filter(F.col("_pop") == 1)
    return g.select(*_feature_cols(ledger, window, key, date),
                    (F.lit(1) - F.col("_tgt")).cast("int").alias(label))


def feature_stats(rfm: DataFrame, cols: list[str]) -> DataFrame:
    """Mean (2 dp), min and max of each feature, one row per feature: one
    aggregation (SQL text, one JVM call) unpivoted with ``stack``."""
    aggs = []
    for i, c in enumerate(cols):
        x = f"CAST({q(c)} AS DOUBLE)"
        aggs += [f"avg({x}) AS _a{i}", f"min({x}) AS _n{i}", f"max({x}) AS _x{i}"]
    one = rfm.agg(*[F.expr(a) for a in aggs])
    items = ", ".join(f"{i}, {sql_literal(c)}, rint(_a{i} * 100.0D) / 100.0D, _n{i}, _x{i}" for i, c in enumerate(cols))
    long = one.selectExpr(f"stack({len(cols)}, {items}) AS (pos, feature, mean_value, min_value, max_value)")
    return long.orderBy("pos").drop("pos")
