"""Grouped summaries behind the study's charts: shares, describe, box plot,
histogram, centres, metric means, daily / monthly volume with the econ series.

Per-group statistics are joined back to rows only where the group domain is
bounded by a given list (segments) or by the label values, so the broadcast
side is small by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.config import LABEL_COL
from lapse.functions.columns import present
from lapse.functions.numeric import half_even, pct
from lapse.functions.ordering import reindex
from lapse.functions.quantiles import exact_quantiles

# The engagement metrics compared across segments.
ENGAGEMENT_METRICS = ["app_logins_frequency", "feature_usage_diversity",
                      "satisfaction_score", "support_tickets_count"]

# Features of the risk correlation heatmap (the label last).
RISK_FEATURES = [
    "recency_days", "freq_90d", "freq_30d", "freq_7d", "freq_30d_change",
    "avg_value_90d", "support_tickets_count", "resolved_tickets_ratio",
    "app_logins_frequency", "failed_transactions",
    "satisfaction_score", "customer_tenure", "active_products",
    "inactive_next_60d",
]


def segment_share(df: DataFrame, order: Sequence[str], segment: str = "customer_segment",
                  digits: int = 1) -> DataFrame:
    """Rows per listed segment and % of all rows (unlisted and null segments
    count in the total), in list order; absent listed segments give nulls."""
    one = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count_if(F.col(segment) == v).alias(f"_s{i}") for i, v in enumerate(order)])
    # The listed domain is fixed, so counting each value in one pass avoids a
    # shuffle of rows entirely; zero counts become nulls like a reindex does.
    structs = [F.struct(F.lit(v).alias(segment), F.lit(i).alias("_pos"),
                        F.when(F.col(f"_s{i}") > 0, F.col(f"_s{i}")).cast("double").alias("n"))
               for i, v in enumerate(order)]
    long = one.select("_total", F.explode(F.array(*structs)).alias("s")).select("_total", "s.*")
    return (long.select(segment, "n", pct(F.col("n"), F.col("_total"), digits).alias("pct"), "_pos")
                .orderBy("_pos").drop("_pos"))


def describe_by(df: DataFrame, order: Sequence[str], group: str = "customer_segment",
                metric: str = "tx_count", digits: int = 1) -> DataFrame:
    """pandas ``describe`` per listed group: count, mean, sample std, min,
    exact linear-interpolated quartiles, max (``digits`` dp)."""
    x = F.col(metric).cast("double")
    rows = df.filter(F.col(group).isin(list(order))).select(group, x.alias("_x"))
    # At most len(order) groups.
    g = exact_quantiles(rows, group, "_x", [0.25, 0.5, 0.75], few_groups=True, also=[
        F.count("_x").alias("count"), F.avg("_x").alias("mean"), F.stddev_samp("_x").alias("std"),
        F.min("_x").alias("min"), F.max("_x").alias("max")])
    r = lambda c: half_even(c, digits)
    g = g.select(group, F.col("count").cast("double").alias("count"), r(F.col("mean")).alias("mean"),
                 r(F.col("std")).alias("std"), r(F.col("min")).alias("min"),
                 r(F.col("_q")[0]).alias("q25"), r(F.col("_q")[1]).alias("q50"), r(F.col("_q")[2]).alias("q75"),
                 r(F.col("max")).alias("max"))
    return reindex(g, group, order)


def boxplot_stats(df: DataFrame, order: Sequence[str], group: str = "customer_segment",
                  metric: str = "tx_count", whis: float = 1.5) -> DataFrame:
    """Box-plot numbers per listed group: quartiles, whiskers at the furthest
    points within ``whis`` IQR of the box (never inside it), outlier count.

    Two passes: quartiles, then one aggregation over the rows joined to their
    group's quartiles.  A value lies outside the whiskers exactly when it lies
    outside the fences (no value sits between a fence and its whisker), so
    the outlier count needs no third pass.
    """
    x = F.col(metric).cast("double")
    rows = df.filter(F.col(group).isin(list(order)) & x.isNotNull()).select(group, x.alias("_x"))
    quart = exact_quantiles(rows, group, "_x", [0.25, 0.5, 0.75], few_groups=True).select(
        group, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    lo_fence = F.col("q1") - F.lit(whis) * iqr
    hi_fence = F.col("q3") + F.lit(whis) * iqr
    # At most len(order) rows: the broadcast side has a size bound fixed by the list.
    j = rows.join(F.broadcast(quart), group, "inner")
    g = j.groupBy(group, "q1", "median", "q3").agg(
        F.min(F.when(F.col("_x") >= lo_fence, F.col("_x"))).alias("_lo"),
        F.max(F.when(F.col("_x") <= hi_fence, F.col("_x"))).alias("_hi"),
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("_x") < lo_fence) | (F.col("_x") > hi_fence)).alias("n_outliers"))
    wlo = F.least(F.coalesce(F.col("_lo"), F.col("q1")), F.col("q1"))
    whi = F.greatest(F.coalesce(F.col("_hi"), F.col("q3")), F.col("q3"))
    g = g.select(group, F.col("n").cast("double").alias("n"), "q1", "median", "q3",
                 wlo.alias("whisker_low"), whi.alias("whisker_high"),
                 F.col("n_outliers").cast("double").alias("n_outliers"))
    return reindex(g, group, order)


def histogram_by(df: DataFrame, group: str = LABEL_COL, col: str = "recency_days",
                 bins: int = 40, clip: float | None = 200.0, digits: int = 4,
                 groups: Sequence | None = None) -> DataFrame:
    """Equal-width histogram per group over the group's own (clipped) range.

    Bin assignment follows numpy: the index from the scaled offset, then a
    correction against the linspace edges; the last bin is closed; a constant
    group uses the range value +- 0.5.  All ``bins`` bins are returned, empty
    ones with n = 0.

    With ``groups`` (e.g. the label values 0 and 1) rows are restricted to
    those values and the per-group ranges are broadcast (at most len(groups)
    rows); without it AQE picks the join for the ranges at run time.
    """
    x = F.col(col).cast("double")
    if clip is not None:
        x = F.least(x, F.lit(float(clip)))
    keep = F.col(group).isNotNull() & F.col(col).isNotNull()
    if groups is not None:
        keep = keep & F.col(group).isin(list(groups))
    rows = df.filter(keep).select(group, x.alias("_x"))
    rng = rows.groupBy(group).agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    same = F.col("_mn") == F.col("_mx")
    rng = rng.select(group, F.when(same, F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
                     F.when(same, F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"))
    nb = F.lit(bins)
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))

    def edge(i):
        return F.when(i >= nb, F.col("_hi")).otherwise(i.cast("double") * step + F.col("_lo"))

    j = rows.join(F.broadcast(rng) if groups is not None else rng, group, "inner")
    i0 = F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.lit(float(bins)))
    i0 = F.when(i0 >= nb, nb - 1).otherwise(i0)
    j = j.withColumn("_i", i0)
    j = j.withColumn("_i", F.when(F.col("_x") < edge(F.col("_i")), F.col("_i") - 1).otherwise(F.col("_i")))
    j = j.withColumn("_i", F.when((F.col("_x") >= edge(F.col("_i") + 1)) & (F.col("_i") != nb - 1),
                                  F.col("_i") + 1).otherwise(F.col("_i")))
    counts = j.groupBy(group, "_lo", "_hi", F.col("_i").cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # One row per group with its non-empty bins as a map (at most ``bins``
    # entries), then every bin from 0 to bins-1: the ranges are used once.
    per_group = counts.groupBy(group, "_lo", "_hi").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_m"))
    b = F.col("bin")
    out = (per_group.select(group, "_lo", "_hi", "_m", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
                    .select(group, "bin",
                            half_even(edge(b), digits).alias("bin_lo"),
                            half_even(edge(b + 1), digits).alias("bin_hi"),
                            F.coalesce(F.try_element_at("_m", b), F.lit(0).cast("bigint")).alias("n")))
    return out.orderBy(group, "bin")


def group_center(df: DataFrame, group: str = LABEL_COL, col: str = "recency_days",
                 digits: int = 1) -> DataFrame:
    """Rows, exact median and mean of ``col`` per group value."""
    x = F.col(col).cast("double")
    rows = df.filter(F.col(group).isNotNull()).select(group, x.alias("_x"))
    return (exact_quantiles(rows, group, "_x", [0.5], also=[F.count(F.lit(1)).alias("n"), F.avg("_x").alias("_mean")])
                .select(group, "n", half_even(F.col("_q")[0], digits).alias("median"), half_even(F.col("_mean"), digits).alias("mean"))
                .orderBy(group))


def metric_means(df: DataFrame, order: Sequence[str], group: str = "customer_segment",
                 metrics: Sequence[str] = ENGAGEMENT_METRICS, digits: int = 2) -> DataFrame:
    """Long form ``(metric, group, mean)`` for each present metric and listed group."""
    metrics = present(df, metrics)
    if not metrics:
        return df.select(F.lit("").alias("metric"), group, F.lit(0.0).alias("mean")).limit(0)
    g = (df.filter(F.col(group).isin(list(order))).groupBy(group)
           .agg(*[F.avg(F.col(m).cast("double")).alias(f"_m{i}") for i, m in enumerate(metrics)]))
    wide = reindex(g, group, order, keep_pos=True)
    structs = [F.struct(F.lit(m).alias("metric"), F.lit(i).alias("_mpos"),
                        half_even(F.col(f"_m{i}"), digits).alias("mean")) for i, m in enumerate(metrics)]
    long = wide.select(group, "pos", F.explode(F.array(*structs)).alias("s")).select(group, "pos", "s.*")
    return long.orderBy("_mpos", "pos").select("metric", group, "mean")


def daily_volume(ledger: DataFrame, date: str = "date") -> DataFrame:
    """Rows per calendar day (days with data only), ascending."""
    return (ledger.groupBy(F.to_date(F.col(date)).alias("date"))
                  .agg(F.count(F.lit(1)).alias("n_transactions")).orderBy("date"))


def monthly_volume_econ(ledger: DataFrame, econ: DataFrame, date: str = "date") -> DataFrame:
    """Rows per month (the monthly sum of daily counts) left-joined to the
    monthly economic series; months outside the series get null rates."""
    monthly = (ledger.groupBy(F.trunc(F.col(date), "month").alias("month"))
                     .agg(F.count(F.lit(1)).alias("n_transactions")))
    # The series is a 12-row literal table.
    out = monthly.join(F.broadcast(econ), "month", "left")
    # Months outside the series leave the rate null, so it is a double (as after a pandas merge).
    return out.select("month", F.date_format("month", "MMM").alias("month_label"), "n_transactions",
                      F.col("cop_usd_rate").cast("double").alias("cop_usd_rate"),
                      "inflation_monthly_pct").orderBy("month")


def extreme_month(monthly: DataFrame, rate: str = "cop_usd_rate", lowest: bool = True) -> DataFrame:
    """The month with the lowest (or highest) non-null rate; first month on ties."""
    w = Window.orderBy(F.asc(rate) if lowest else F.desc(rate), "month")
    # Over one row per month of data.
    return (monthly.filter(F.col(rate).isNotNull()).withColumn("_r", F.row_number().over(w))
                   .filter(F.col("_r") == 1).select("month", rate, "n_transactions"))
