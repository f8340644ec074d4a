"""Column exclusion, exact dedup, date coverage, monthly counts, zero fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.functions.columns import present
from lapse.functions.numeric import half_even, q, sql_literal

# The four batch-computed profile columns the original study
# excludes because they do not reconcile with the raw ledger.
GROUP_B_COLS = [
    "average_transaction_value",
    "total_transaction_volume",
    "weekend_transaction_ratio",
    "last_transaction_date",
]

# Columns the study fills with 0 before modelling.
FILL_ZERO_COLS = [
    "credit_utilization_ratio",
    "support_tickets_count",
    "resolved_tickets_ratio",
    "failed_transactions",
]


def exclude_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist; ignore the others."""
    return df.drop(*present(df, cols))


def exclusion_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per listed column: whether it is present (and so excluded) and the non-null cells that go with it."""
    have = present(df, cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, present boolean, status string, n_cells double")
    one = df.agg(F.expr("count(1) AS _rows"), *[F.expr(f"count({q(c)}) AS _n{i}") for i, c in enumerate(cols) if c in have])
    items = ", ".join(f"{sql_literal(c)}, {str(c in have).lower()}, {sql_literal('excluded' if c in have else 'not in data')}, "
                      + (f"CAST(_n{i} AS DOUBLE)" if c in have else "CAST(NULL AS DOUBLE)") for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {items}) AS (column_name, present, status, n_cells)")


def _by_all_columns(df: DataFrame, map_side_combine: bool) -> DataFrame:
    # With map-side combining (the default) every task merges its copies of a
    # row before the shuffle, so even one row copied into a third of the
    # ledger reaches its reducer at most once per task.  Without it (a
    # repartition on all columns first) both aggregation phases run on the
    # reducers: one hash pass less when duplicates are known to be rare and
    # scattered, but every copy of a hot row then meets in one task.
    return df if map_side_combine else df.repartition(*df.columns)


def dedup_exact(df: DataFrame, map_side_combine: bool = True) -> DataFrame:
    """Drop exact duplicate rows over all columns.

    The exchange hashes on every column, so a hot customer is spread over
    reducers by its dates and amounts, and map-side combining collapses a hot
    group of identical copies before the shuffle.  Which copy survives does
    not matter: copies are identical.
    """
    return _by_all_columns(df, map_side_combine).dropDuplicates()


def dedup_stats(df: DataFrame, map_side_combine: bool = True) -> DataFrame:
    """Rows before / after exact dedup, rows removed and their % (4 dp), one pass."""
    groups = _by_all_columns(df, map_side_combine).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    tot = groups.agg(F.sum("_copies").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
    removed = F.col("rows_before") - F.col("rows_after")
    return tot.select(
        "rows_before", "rows_after", removed.alias("removed"),
        half_even(removed / F.col("rows_before") * F.lit(100.0), 4).alias("removed_pct"))


def date_coverage(df: DataFrame, date: str = "date") -> DataFrame:
    """First and last date, calendar days between (inclusive), active and empty days.

    Both ends are truncated to the day, so intraday data cannot undercount.
    """
    day = F.to_date(F.col(date))
    agg = df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"),
                 F.count_distinct(day).alias("active_days"))
    calendar = (F.datediff("max_date", "min_date") + 1).cast("bigint")
    return agg.select("min_date", "max_date", calendar.alias("calendar_days"), "active_days",
                      (calendar - F.col("active_days")).alias("empty_days"))


def daily_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Every calendar day from the first to the last with its rows, days without rows included.

    The days are generated from the two ends and left-joined to the counts: one
    row per calendar day on either side.
    """
    days = df.groupBy(F.to_date(F.col(date)).alias("date")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("date").isNotNull())
    ends = days.agg(F.min("date").alias("_lo"), F.max("date").alias("_hi")).filter(F.col("_lo").isNotNull())
    calendar = ends.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return calendar.join(days, "date", "left").select("date", F.coalesce("_n", F.lit(0)).alias("n_rows")).orderBy("date")


def empty_days(df: DataFrame, date: str = "date") -> DataFrame:
    """The calendar days without rows, each with the first day and the length of its gap."""
    calendar = daily_calendar(df, date)
    # Over one row per calendar day; days of one gap share the last day with rows before them.
    last = F.max(F.when(F.col("n_rows") > 0, F.col("date"))).over(Window.orderBy("date"))
    gaps = calendar.select("date", "n_rows", last.alias("_since")).filter(F.col("n_rows") == 0)
    length = F.count(F.lit(1)).over(Window.partitionBy("_since"))
    return gaps.select("date", F.date_add("_since", 1).alias("gap_start"), length.alias("gap_days")).orderBy("date")


def monthly_counts(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows per calendar month, months with data only, ascending."""
    return (df.groupBy(F.trunc(F.col(date), "month").alias("month"))
              .agg(F.count(F.lit(1)).alias("n_rows"))
              .orderBy("month"))


def zero_fill(df: DataFrame, cols: Sequence[str] = FILL_ZERO_COLS) -> DataFrame:
    """Fill nulls with 0 in the listed numeric columns that exist."""
    cols = present(df, cols)
    return df.fillna(0, subset=cols) if cols else df
