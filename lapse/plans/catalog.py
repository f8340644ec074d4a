"""Query catalog: name -> (Spark query over an sf directory, DuckDB oracle SQL).

Every query reads the driver's parquet tables through the input views of
``lapse.sources.views`` and runs over whole tables.  The SQL is generated from
the same column lists and study windows as the Spark side.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lapse.config import INTRADAY_WINDOW, LABEL_COL, LEDGER_WINDOW
from lapse.operators import cleaning as C
from lapse.operators import dataset as D
from lapse.operators import features as A
from lapse.operators import integrity as J
from lapse.operators import profiling as P
from lapse.operators import summaries as S
from lapse.plans import oracle as O
from lapse.plans.study import Study
from lapse.session import scratch_folder
from lapse.sources.views import PROFILE_SEGMENT_ORDER, Tables

# Profile columns excluded for the test profile (the last one is
# absent on purpose).
PROFILE_EXCLUDE = ["first_tx", "last_tx", "weekend_transaction_ratio"]

W = LEDGER_WINDOW
WI = INTRADAY_WINDOW
ORDER = PROFILE_SEGMENT_ORDER
PROFILE_COLS = [c for c, _ in O.PROFILE_COLUMNS]
MODEL_COLS = ([c for c in PROFILE_COLS if c not in PROFILE_EXCLUDE]
              + ["recency_days", "freq_90d", "freq_30d", "freq_7d", "avg_value_90d", "freq_30d_change", LABEL_COL])
CAT_PRESENT = [c for c in D.CAT_COLS if c in PROFILE_COLS]
FILL_PRESENT = [c for c in C.FILL_ZERO_COLS if c in PROFILE_COLS]
RFM_COLS = ["recency_days", "freq_90d", "freq_30d", "freq_7d", "avg_value_90d", "freq_30d_change"]


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def study(spark: SparkSession, sf_dir: str) -> Study:
    t = Tables(spark, sf_dir)
    return Study(t.profile, t.ledger, W, exclude=PROFILE_EXCLUDE)


CATALOG: list[Query] = []


def register(name: str, sql: str | None):
    def deco(fn):
        CATALOG.append(Query(name, fn, sql))
        return fn
    return deco


def V(body: str, *views: str, extra=()) -> str:
    return O.with_views(body, *views, extra=extra)


MODEL_CTES = [("rfm", O.rfm_sql("tx_clean", W)), ("lbl", O.label_sql("tx_clean", W)),
              ("model", O.model_sql(PROFILE_EXCLUDE))]
SPLIT_CTES = MODEL_CTES + [("split_df", O.split_sql("model"))]
TS = O.ts
DOM = ("dom", O.domain_values("customer_segment", ORDER))
SEG_IN = f"customer_segment IN ({O.lit_list(ORDER)})"


# == S: scans and sources ==================================================================

@register("scan_profile", V("SELECT * FROM profile", "profile"))
def q_scan_profile(spark, sf):
    return Tables(spark, sf).profile


@register("scan_ledger", V("SELECT * FROM ledger", "ledger"))
def q_scan_ledger(spark, sf):
    return Tables(spark, sf).ledger


@register("source_summary", V(f"""SELECT source, n_rows, CAST(n_cols AS DOUBLE) AS n_cols FROM (
  SELECT 'profile' AS source, COUNT(*) AS n_rows, {len(PROFILE_COLS)} AS n_cols, 0 AS o FROM profile
  UNION ALL SELECT 'ledger', COUNT(*), 4, 0 FROM ledger
  UNION ALL SELECT 'econ', COUNT(*), 3, 0 FROM econ) s
UNION ALL SELECT 'total', CAST((SELECT COUNT(*) FROM profile) + (SELECT COUNT(*) FROM ledger)
  + (SELECT COUNT(*) FROM econ) AS BIGINT), NULL""", "profile", "ledger", "econ"))
def q_source_summary(spark, sf):
    t = Tables(spark, sf)
    return P.source_summary({"profile": t.profile, "ledger": t.ledger, "econ": t.econ})


@register("preview_ledger", V("SELECT * FROM ledger ORDER BY customer_id, date, amount, type LIMIT 5", "ledger"))
def q_preview(spark, sf):
    return P.preview(Tables(spark, sf).ledger, 5)


# == P: profiling ==========================================================================

def _describe(view_sql: str) -> str:
    cases = " ".join(f"WHEN '{d}' THEN '{s}'" for d, s in [
        ("BIGINT", "bigint"), ("INTEGER", "int"), ("VARCHAR", "string"), ("DOUBLE", "double"),
        ("BOOLEAN", "boolean"), ("TIMESTAMP", "timestamp_ntz"), ("DATE", "date")])
    return (f"SELECT CAST(row_number() OVER () AS INTEGER) AS ordinal, column_name, "
            f"CASE column_type {cases} ELSE lower(column_type) END AS dtype FROM (DESCRIBE {view_sql})")


def _filled_sql(view: str, cols: list[str]) -> str:
    """(column_name, n_filled) of the listed columns."""
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT({c}) AS n_filled FROM {view}" for c in cols)


OVERVIEW_SQL = V(f"""SELECT d.ordinal, d.column_name, d.dtype, f.n_filled
FROM ({_describe(O.VIEWS['profile'])}) d JOIN ({_filled_sql('profile', PROFILE_COLS)}) f ON d.column_name = f.column_name""", "profile")


@register("column_overview", OVERVIEW_SQL)
def q_column_overview(spark, sf):
    return P.column_overview(Tables(spark, sf).profile)


@register("dtype_counts", f"SELECT dtype, COUNT(*) AS n_columns, CAST(SUM(n_filled) AS BIGINT) AS n_filled FROM ({OVERVIEW_SQL}) GROUP BY dtype")
def q_dtype_counts(spark, sf):
    return P.dtype_counts(Tables(spark, sf).profile)


@register("ledger_profile", V("""SELECT CAST(MIN(date) AS DATE) AS min_date, CAST(MAX(date) AS DATE) AS max_date,
  COUNT(DISTINCT customer_id) AS n_customers, string_agg(DISTINCT type, ',' ORDER BY type) AS types, COUNT(DISTINCT type) AS n_types,
  MIN(amount) AS amount_min, MAX(amount) AS amount_max FROM ledger""", "ledger"))
def q_ledger_profile(spark, sf):
    return P.ledger_profile(Tables(spark, sf).ledger)


@register("ledger_types", V("""SELECT row_number() OVER (ORDER BY type) AS position, type, n_rows
FROM (SELECT type, COUNT(*) AS n_rows FROM ledger WHERE type IS NOT NULL GROUP BY type)""", "ledger"))
def q_ledger_types(spark, sf):
    return P.ledger_types(Tables(spark, sf).ledger)


@register("ledger_types_free_text", """SELECT row_number() OVER (ORDER BY type) AS position, type, n_rows
FROM (SELECT url AS type, COUNT(*) AS n_rows FROM pages WHERE url IS NOT NULL GROUP BY url)""")
def q_ledger_types_free_text(spark, sf):
    """A type column of free text: as many types as rows."""
    return P.ledger_types(Tables(spark, sf).table("pages"), "url")


def _missing_sql(view: str, cols: list[str], structural: dict) -> str:
    counts = ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS m{i}" for i, c in enumerate(cols))
    long = " UNION ALL ".join(f"SELECT {i} AS ordinal, '{c}' AS column_name, m{i} AS missing_count, n FROM agg"
                              for i, c in enumerate(cols))
    lookup = ", ".join(f"('{k}', '{v}')" for k, v in structural.items())
    return V(f"""SELECT l.column_name, l.missing_count, round_even(l.missing_count / l.n * 100.0E0, 2) AS missing_pct,
  COALESCE(k.classification, '{P.DEFAULT_CLASS}') AS classification
FROM long l LEFT JOIN (VALUES {lookup}) k(column_name, classification) ON l.column_name = k.column_name
WHERE l.missing_count > 0""", view,
             extra=[("agg", f"SELECT COUNT(*) AS n, {counts} FROM {view}"), ("long", long)])


@register("missing_audit", _missing_sql("profile", PROFILE_COLS, P.STRUCTURAL_COLS))
def q_missing_audit(spark, sf):
    return P.missing_audit(Tables(spark, sf).profile)


@register("missing_audit_doc_labels", _missing_sql("doc_labels", O.DOC_LABEL_COLUMNS, P.STRUCTURAL_COLS))
def q_missing_audit_docs(spark, sf):
    return P.missing_audit(Tables(spark, sf).doc_labels)


def _structural_sql() -> str:
    parts = []
    for c, flag in P.STRUCTURAL_FLAGS.items():
        if c not in PROFILE_COLS:
            continue
        if flag and flag in PROFILE_COLS:
            parts.append(f"SELECT '{c}' AS column_name, '{flag}' AS flag_column, "
                         f"CAST(COUNT(*) FILTER (WHERE NOT {flag}) AS DOUBLE) AS flag_false_count, "
                         f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM profile")
        else:
            parts.append(f"SELECT '{c}', CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), "
                         f"COUNT(*) FILTER (WHERE {c} IS NULL) FROM profile")
    return V(" UNION ALL ".join(parts), "profile")


@register("structural_missing_check", _structural_sql())
def q_structural(spark, sf):
    return P.structural_missing_check(Tables(spark, sf).profile)


def _segment_summary_sql() -> str:
    metrics = [m for m in P.SEGMENT_METRICS if m in PROFILE_COLS]
    means = ", ".join(f"round_even(AVG(CAST({m} AS DOUBLE)), 2) AS {P.mean_name(m)}" for m in metrics)
    return V(f"""SELECT dom.customer_segment, g.* EXCLUDE (customer_segment) FROM dom LEFT JOIN (
  SELECT customer_segment, CAST(COUNT(customer_id) AS DOUBLE) AS customer_count, {means}
  FROM profile WHERE {SEG_IN} GROUP BY customer_segment) g ON dom.customer_segment = g.customer_segment
ORDER BY dom.pos""", "profile", extra=[DOM])


@register("segment_summary", _segment_summary_sql())
def q_segment_summary(spark, sf):
    return P.segment_summary(Tables(spark, sf).profile, ORDER)


CORR_COLS = [c for c in P.CORR_FEATURES if c in PROFILE_COLS]


def _corr_agg(view: str, cols: list[str], diagonal: bool) -> str:
    items = []
    for i in range(len(cols)):
        for j in range(i + (0 if diagonal else 1), len(cols)):
            expr = O.self_corr(cols[i]) if i == j else O.pair_corr(cols[i], cols[j])
            items.append(f"{expr} AS c_{i}_{j}")
    return f"SELECT {', '.join(items)} FROM {view}"


def _corr_pairs_sql(cols, digits, diagonal, mirror):
    rows = []
    for i in range(len(cols)):
        for j in range(i + (0 if diagonal else 1), len(cols)):
            rows.append(f"SELECT '{cols[i]}' AS feature_a, '{cols[j]}' AS feature_b, {i} AS pos_a, {j} AS pos_b, "
                        f"round_even(c_{i}_{j}, {digits}) AS corr, round_even(c_{i}_{j}, 12) AS raw FROM cagg")
            if mirror and i != j:
                rows.append(f"SELECT '{cols[j]}', '{cols[i]}', {j}, {i}, round_even(c_{i}_{j}, {digits}), round_even(c_{i}_{j}, 12) FROM cagg")
    return " UNION ALL ".join(rows)


@register("correlation_matrix", V("SELECT feature_a, feature_b, corr FROM pairs ORDER BY pos_a, pos_b", "profile",
                                  extra=[("cagg", _corr_agg("profile", CORR_COLS, True)),
                                         ("pairs", _corr_pairs_sql(CORR_COLS, 3, True, True))]))
def q_corr_matrix(spark, sf):
    return P.correlation_matrix(Tables(spark, sf).profile)


def _top_pairs_sql(largest: bool) -> str:
    direction = "DESC" if largest else "ASC"
    return V(f"""SELECT CAST(rank AS INTEGER) AS rank, feature_a, feature_b, corr FROM (
  SELECT *, row_number() OVER (ORDER BY raw {direction}, pos_a, pos_b) AS rank FROM pairs WHERE corr IS NOT NULL)
WHERE rank <= 10 ORDER BY rank""", "profile",
             extra=[("cagg", _corr_agg("profile", CORR_COLS, False)),
                    ("pairs", _corr_pairs_sql(CORR_COLS, 3, False, False))])


@register("correlation_top_pairs", _top_pairs_sql(True))
def q_corr_top(spark, sf):
    return P.correlation_pairs(Tables(spark, sf).profile, k=10, largest=True)


@register("correlation_bottom_pairs", _top_pairs_sql(False))
def q_corr_bottom(spark, sf):
    return P.correlation_pairs(Tables(spark, sf).profile, k=10, largest=False)


# == D: projections, filters, cleaning =====================================================

EXCL_PRESENT = [c for c in PROFILE_EXCLUDE if c in PROFILE_COLS]


@register("exclude_columns", V(f"SELECT * EXCLUDE ({', '.join(EXCL_PRESENT)}) FROM profile", "profile"))
def q_exclude(spark, sf):
    return C.exclude_columns(Tables(spark, sf).profile, PROFILE_EXCLUDE)


def _exclusion_sql(view_text: str, cols: list[str], have: list[str]) -> str:
    filled = [c for c in cols if c in have]
    return f"""SELECT e.column_name, d.column_name IS NOT NULL AS present,
  CASE WHEN d.column_name IS NOT NULL THEN 'excluded' ELSE 'not in data' END AS status, CAST(f.n_filled AS DOUBLE) AS n_cells
FROM (VALUES {', '.join(f"('{c}')" for c in cols)}) e(column_name)
LEFT JOIN (DESCRIBE {view_text}) d ON e.column_name = d.column_name
LEFT JOIN ({_filled_sql(f"({view_text})", filled)}) f ON e.column_name = f.column_name"""


@register("exclusion_report", _exclusion_sql(O.VIEWS["profile"], PROFILE_EXCLUDE, PROFILE_COLS))
def q_exclusion_report(spark, sf):
    return C.exclusion_report(Tables(spark, sf).profile, PROFILE_EXCLUDE)


@register("dedup_exact", V("SELECT DISTINCT * FROM ledger_dup", "ledger_dup"))
def q_dedup(spark, sf):
    return C.dedup_exact(Tables(spark, sf).ledger_dup)


@register("dedup_stats", V("""SELECT rows_before, rows_after, rows_before - rows_after AS removed,
  round_even((rows_before - rows_after) / rows_before * 100.0E0, 4) AS removed_pct
FROM (SELECT (SELECT COUNT(*) FROM ledger_dup) AS rows_before,
             (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM ledger_dup)) AS rows_after)""", "ledger_dup"))
def q_dedup_stats(spark, sf):
    return C.dedup_stats(Tables(spark, sf).ledger_dup)


def _coverage_sql(view: str) -> str:
    return V(f"""SELECT min_date, max_date, calendar_days, active_days, calendar_days - active_days AS empty_days FROM (
  SELECT CAST(MIN(date) AS DATE) AS min_date, CAST(MAX(date) AS DATE) AS max_date,
    CAST(date_diff('day', CAST(MIN(date) AS DATE), CAST(MAX(date) AS DATE)) + 1 AS BIGINT) AS calendar_days,
    COUNT(DISTINCT CAST(date AS DATE)) AS active_days FROM {view})""", view)


@register("date_coverage", _coverage_sql("tx_clean"))
def q_coverage(spark, sf):
    # min, max and distinct days cannot change under dedup: read the ledger as is
    return C.date_coverage(study(spark, sf).ledger)


@register("date_coverage_intraday", _coverage_sql("ledger_intraday"))
def q_coverage_intraday(spark, sf):
    return C.date_coverage(Tables(spark, sf).ledger_intraday)


@register("daily_calendar", V("""SELECT d.date, COALESCE(n.n, 0) AS n_rows
FROM (SELECT CAST(unnest(generate_series(MIN(date)::DATE, MAX(date)::DATE, INTERVAL 1 DAY)) AS DATE) AS date FROM ledger) d
LEFT JOIN (SELECT CAST(date AS DATE) AS date, COUNT(*) AS n FROM ledger GROUP BY 1) n ON d.date = n.date""", "ledger"))
def q_daily_calendar(spark, sf):
    return C.daily_calendar(Tables(spark, sf).ledger)


# The rows of one customer in a hundred leave many days empty.
@register("empty_days", V("""SELECT date, CAST(gap_start AS DATE) AS gap_start, COUNT(*) OVER (PARTITION BY gap_start) AS gap_days FROM (
  SELECT d.date, MAX(CASE WHEN n.n IS NOT NULL THEN d.date END) OVER (ORDER BY d.date) + 1 AS gap_start, n.n
  FROM (SELECT CAST(unnest(generate_series(MIN(date)::DATE, MAX(date)::DATE, INTERVAL 1 DAY)) AS DATE) AS date FROM part) d
  LEFT JOIN (SELECT CAST(date AS DATE) AS date, COUNT(*) AS n FROM part GROUP BY 1) n ON d.date = n.date)
WHERE n IS NULL""", "ledger", extra=[("part", "SELECT * FROM ledger WHERE customer_id % 100 = 0")]))
def q_empty_days(spark, sf):
    return C.empty_days(Tables(spark, sf).ledger.filter("customer_id % 100 = 0"))


@register("monthly_counts", V("""SELECT CAST(date_trunc('month', date) AS DATE) AS month, COUNT(*) AS n_rows
FROM tx_clean GROUP BY 1 ORDER BY 1""", "tx_clean"))
def q_monthly_counts(spark, sf):
    return C.monthly_counts(study(spark, sf).tx_clean)


@register("observation_rows", V(f"SELECT * FROM tx_clean WHERE date <= {TS(W.cutoff)}", "tx_clean"))
def q_observation(spark, sf):
    return A.observation(study(spark, sf).tx_clean, W)


@register("target_rows", V(f"SELECT * FROM tx_clean WHERE date >= {TS(W.target_lo)} AND date <= {TS(W.target_hi)}",
                           "tx_clean"))
def q_target(spark, sf):
    return A.target_window(study(spark, sf).tx_clean, W)


def _window_counts_sql(view, w):
    return V(f"""SELECT COUNT(*) FILTER (WHERE date <= {TS(w.cutoff)}) AS n_observation,
  COUNT(*) FILTER (WHERE date >= {TS(w.target_lo)} AND date <= {TS(w.target_hi)}) AS n_target FROM {view}""", view)


@register("window_counts", _window_counts_sql("tx_clean", W))
def q_window_counts(spark, sf):
    return A.window_counts(study(spark, sf).tx_clean, W)


@register("window_counts_intraday", _window_counts_sql("ledger_intraday", WI))
def q_window_counts_intraday(spark, sf):
    return A.window_counts(Tables(spark, sf).ledger_intraday, WI)


@register("zero_fill", V("SELECT * REPLACE (" + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in FILL_PRESENT)
                         + ") FROM profile", "profile"))
def q_zero_fill(spark, sf):
    return C.zero_fill(Tables(spark, sf).profile)


# == J: joins and set operations ===========================================================

def _integrity_sql(parent_view: str, child_view: str) -> str:
    return V(f"""SELECT n_parent_keys, n_child_keys, n_both, n_parent_only, n_child_only,
  CASE WHEN n_parent_only = 0 AND n_child_only = 0 THEN 'complete'
       WHEN n_parent_only > 0 THEN 'parents_without_children' ELSE 'children_without_parent' END AS verdict
FROM (SELECT COUNT(p.k) AS n_parent_keys, COUNT(c.k) AS n_child_keys,
        COUNT(*) FILTER (WHERE p.k IS NOT NULL AND c.k IS NOT NULL) AS n_both,
        COUNT(*) FILTER (WHERE p.k IS NOT NULL AND c.k IS NULL) AS n_parent_only,
        COUNT(*) FILTER (WHERE p.k IS NULL AND c.k IS NOT NULL) AS n_child_only
      FROM (SELECT DISTINCT customer_id AS k FROM {parent_view} WHERE customer_id IS NOT NULL) p
      FULL OUTER JOIN (SELECT DISTINCT customer_id AS k FROM {child_view} WHERE customer_id IS NOT NULL) c
      ON p.k = c.k)""", parent_view, child_view)


@register("referential_integrity", _integrity_sql("profile", "tx_clean"))
def q_integrity(spark, sf):
    s = study(spark, sf)
    # distinct keys cannot change under dedup: read the ledger as is
    return J.referential_integrity(C.exclude_columns(s.profile, PROFILE_EXCLUDE), s.ledger)


@register("referential_integrity_events", _integrity_sql("profile", "ledger_intraday"))
def q_integrity_events(spark, sf):
    t = Tables(spark, sf)
    return J.referential_integrity(t.profile, t.ledger_intraday)


@register("keys_in_both", V("""SELECT customer_id FROM profile WHERE customer_id IS NOT NULL
INTERSECT SELECT customer_id FROM ledger_intraday WHERE customer_id IS NOT NULL""", "profile", "ledger_intraday"))
def q_keys_in_both(spark, sf):
    t = Tables(spark, sf)
    return J.keys_in_both(t.profile, t.ledger_intraday)


@register("customers_without_tx", V("""SELECT customer_id FROM profile WHERE customer_id IS NOT NULL
EXCEPT SELECT customer_id FROM ledger_intraday""", "profile", "ledger_intraday"))
def q_keys_without(spark, sf):
    t = Tables(spark, sf)
    return J.keys_without(t.profile, t.ledger_intraday)


# == A: aggregations and features ==========================================================

@register("recency_days", V(f"""SELECT customer_id, MAX(date) AS last_tx_date,
  date_sub('day', MAX(date), {TS(W.cutoff)}) AS recency_days
FROM tx_clean WHERE date <= {TS(W.cutoff)} AND customer_id IS NOT NULL GROUP BY customer_id""", "tx_clean"))
def q_recency(spark, sf):
    # the last date per customer cannot change under dedup: read the ledger as is
    return A.recency(study(spark, sf).ledger, W)


@register("windowed_frequency", V(f"""SELECT customer_id, """ + ", ".join(
    f"COUNT(*) FILTER (WHERE date >= {TS(W.window_start(d))}) AS freq_{d}d" for d in reversed(W.days)) + f"""
FROM tx_clean WHERE date <= {TS(W.cutoff)} AND date >= {TS(W.window_start(W.widest))} AND customer_id IS NOT NULL
GROUP BY customer_id""", "tx_clean"))
def q_frequency(spark, sf):
    return A.frequency(study(spark, sf).tx_clean, W)


@register("windowed_avg_value", V(f"""SELECT customer_id, {O.exact_mean('amount')} AS avg_value_90d
FROM tx_clean WHERE date <= {TS(W.cutoff)} AND date >= {TS(W.window_start(W.widest))} AND customer_id IS NOT NULL
GROUP BY customer_id""", "tx_clean"))
def q_avg_value(spark, sf):
    return A.average_value(study(spark, sf).tx_clean, W)


@register("rfm_features", V("SELECT * FROM rfm", "tx_clean", extra=[("rfm", O.rfm_sql("tx_clean", W))]))
def q_rfm(spark, sf):
    return study(spark, sf).rfm


@register("rfm_features_intraday", V("SELECT * FROM rfm", "tx_intraday", extra=[("rfm", O.rfm_sql("tx_intraday", WI))]))
def q_rfm_intraday(spark, sf):
    return A.rfm_features(C.dedup_exact(Tables(spark, sf).ledger_intraday), WI)


def _feature_stats_sql() -> str:
    aggs = ", ".join(f"AVG(CAST({c} AS DOUBLE)) AS a{i}, MIN(CAST({c} AS DOUBLE)) AS n{i}, MAX(CAST({c} AS DOUBLE)) AS x{i}"
                     for i, c in enumerate(RFM_COLS))
    rows = " UNION ALL ".join(f"SELECT {i} AS pos, '{c}' AS feature, round_even(a{i}, 2) AS mean_value, "
                              f"n{i} AS min_value, x{i} AS max_value FROM st" for i, c in enumerate(RFM_COLS))
    return V(f"SELECT feature, mean_value, min_value, max_value FROM ({rows}) ORDER BY pos", "tx_clean",
             extra=[("rfm", O.rfm_sql("tx_clean", W)), ("st", f"SELECT {aggs} FROM rfm")])


@register("feature_stats", _feature_stats_sql())
def q_feature_stats(spark, sf):
    return A.feature_stats(study(spark, sf).rfm, RFM_COLS)


@register("inactivity_label", V("SELECT * FROM lbl", "tx_clean", extra=[("lbl", O.label_sql("tx_clean", W))]))
def q_label(spark, sf):
    return study(spark, sf).label


@register("inactivity_label_intraday", V("SELECT * FROM lbl", "tx_intraday",
                                         extra=[("lbl", O.label_sql("tx_intraday", WI))]))
def q_label_intraday(spark, sf):
    return A.inactivity_label(C.dedup_exact(Tables(spark, sf).ledger_intraday), WI)


@register("label_distribution", V(f"""SELECT {LABEL_COL}, n, round_even(n / SUM(n) OVER () * 100.0E0, 1) AS pct
FROM (SELECT {LABEL_COL}, COUNT(*) AS n FROM lbl GROUP BY 1) ORDER BY 1""", "tx_clean",
                                  extra=[("lbl", O.label_sql("tx_clean", W))]))
def q_label_dist(spark, sf):
    return D.label_distribution(study(spark, sf).label)


@register("model_dataset", V("SELECT * FROM model", "tx_clean", "profile", extra=MODEL_CTES))
def q_model(spark, sf):
    return study(spark, sf).model


@register("segment_share", V(f"""SELECT dom.customer_segment, g.n,
  round_even(g.n / (SELECT COUNT(*) FROM profile) * 100.0E0, 1) AS pct
FROM dom LEFT JOIN (SELECT customer_segment, CAST(COUNT(*) AS DOUBLE) AS n FROM profile WHERE {SEG_IN} GROUP BY 1) g
  ON dom.customer_segment = g.customer_segment ORDER BY dom.pos""", "profile", extra=[DOM]))
def q_segment_share(spark, sf):
    return S.segment_share(Tables(spark, sf).profile, ORDER)


@register("describe_by_segment", V(f"""SELECT dom.customer_segment, g.* EXCLUDE (customer_segment) FROM dom LEFT JOIN (
  SELECT customer_segment, CAST(COUNT(x) AS DOUBLE) AS count, round_even(AVG(x), 1) AS mean,
    round_even(stddev_samp(x), 1) AS std, round_even(MIN(x), 1) AS min,
    round_even(quantile_cont(x, 0.25), 1) AS q25, round_even(quantile_cont(x, 0.5), 1) AS q50,
    round_even(quantile_cont(x, 0.75), 1) AS q75, round_even(MAX(x), 1) AS max
  FROM (SELECT customer_segment, CAST(tx_count AS DOUBLE) AS x FROM profile WHERE {SEG_IN}) GROUP BY 1) g
  ON dom.customer_segment = g.customer_segment ORDER BY dom.pos""", "profile", extra=[DOM]))
def q_describe(spark, sf):
    return S.describe_by(Tables(spark, sf).profile, ORDER, metric="tx_count")


@register("boxplot_stats", V("""SELECT dom.customer_segment, w.n, w.q1, w.median, w.q3, w.whisker_low,
  w.whisker_high, f.n_outliers
FROM dom LEFT JOIN w ON dom.customer_segment = w.customer_segment
LEFT JOIN f ON dom.customer_segment = f.customer_segment ORDER BY dom.pos""", "profile", extra=[
    DOM,
    ("r", f"SELECT customer_segment, CAST(tx_count AS DOUBLE) AS x FROM profile WHERE {SEG_IN} AND tx_count IS NOT NULL"),
    ("q", """SELECT customer_segment, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
  quantile_cont(x, 0.75) AS q3 FROM r GROUP BY 1"""),
    ("w", """SELECT q.customer_segment, CAST(COUNT(*) AS DOUBLE) AS n, q.q1, q.median, q.q3,
  LEAST(COALESCE(MIN(CASE WHEN r.x >= q.q1 - 1.5E0 * (q.q3 - q.q1) THEN r.x END), q.q1), q.q1) AS whisker_low,
  GREATEST(COALESCE(MAX(CASE WHEN r.x <= q.q3 + 1.5E0 * (q.q3 - q.q1) THEN r.x END), q.q3), q.q3) AS whisker_high
FROM r JOIN q ON r.customer_segment = q.customer_segment GROUP BY q.customer_segment, q.q1, q.median, q.q3"""),
    ("f", """SELECT r.customer_segment,
  CAST(COUNT(*) FILTER (WHERE r.x < w.whisker_low OR r.x > w.whisker_high) AS DOUBLE) AS n_outliers
FROM r JOIN w ON r.customer_segment = w.customer_segment GROUP BY 1"""),
]))
def q_boxplot(spark, sf):
    return S.boxplot_stats(Tables(spark, sf).profile, ORDER, metric="tx_count")


RISK_COLS = [c for c in S.RISK_FEATURES if c in MODEL_COLS]


@register("risk_correlation", V("""SELECT feature_b AS feature_row, feature_a AS feature_col, corr FROM pairs
ORDER BY pos_b, pos_a""", "tx_clean", "profile", extra=MODEL_CTES + [
    ("cagg", _corr_agg("model", RISK_COLS, False)), ("pairs", _corr_pairs_sql(RISK_COLS, 2, False, False))]))
def q_risk_corr(spark, sf):
    return P.correlation_lower(study(spark, sf).model, S.RISK_FEATURES, digits=2)


TARGET_FEATURES = [c for c in RISK_COLS if c != LABEL_COL]


@register("target_correlation", V("SELECT feature, corr FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS pos, '{c}' AS feature, round_even(t{i}, 3) AS corr, round_even(t{i}, 12) AS raw FROM tagg" for i, c in enumerate(TARGET_FEATURES))
    + ") ORDER BY raw ASC NULLS LAST, pos", "tx_clean", "profile", extra=MODEL_CTES + [
    ("tagg", "SELECT " + ", ".join(f"{O.pair_corr(c, LABEL_COL)} AS t{i}" for i, c in enumerate(TARGET_FEATURES))
     + " FROM model")]))
def q_target_corr(spark, sf):
    return P.target_correlation(study(spark, sf).model, S.RISK_FEATURES, LABEL_COL)


def _hist_sql(bins=40, clip=200.0) -> str:
    nb = O.dbl(bins)

    def edge(i):
        return f"(CASE WHEN {i} >= {bins} THEN hi ELSE CAST({i} AS DOUBLE) * ((hi - lo) / {nb}) + lo END)"
    return V(f"""SELECT g.{LABEL_COL}, g.bin, round_even({edge('g.bin')}, 4) AS bin_lo,
  round_even({edge('g.bin + 1')}, 4) AS bin_hi, COALESCE(c.n, 0) AS n
FROM (SELECT rng.*, CAST(b.range AS INTEGER) AS bin FROM rng, range(0, {bins}) b) g
LEFT JOIN c ON g.{LABEL_COL} = c.{LABEL_COL} AND g.bin = c.bin
ORDER BY 1, 2""", "tx_clean", "profile", extra=MODEL_CTES + [
        ("r", f"SELECT {LABEL_COL}, LEAST(CAST(recency_days AS DOUBLE), {O.dbl(clip)}) AS x FROM model "
              f"WHERE {LABEL_COL} IN (0, 1) AND recency_days IS NOT NULL"),
        ("rng", f"""SELECT {LABEL_COL}, CASE WHEN MIN(x) = MAX(x) THEN MIN(x) - 0.5E0 ELSE MIN(x) END AS lo,
  CASE WHEN MIN(x) = MAX(x) THEN MAX(x) + 0.5E0 ELSE MAX(x) END AS hi FROM r GROUP BY 1"""),
        ("j0", f"""SELECT r.x, rng.*, LEAST(CAST(floor((r.x - lo) / (hi - lo) * {nb}) AS BIGINT), {bins - 1}) AS i0
FROM r JOIN rng ON r.{LABEL_COL} = rng.{LABEL_COL}"""),
        ("j1", f"SELECT *, CASE WHEN x < {edge('i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM j0"),
        ("j2", f"SELECT *, CASE WHEN x >= {edge('i1 + 1')} AND i1 != {bins - 1} THEN i1 + 1 ELSE i1 END AS bin FROM j1"),
        ("c", f"SELECT {LABEL_COL}, CAST(bin AS INTEGER) AS bin, COUNT(*) AS n FROM j2 GROUP BY 1, 2"),
    ])


@register("recency_histogram", _hist_sql())
def q_histogram(spark, sf):
    return S.histogram_by(study(spark, sf).model, LABEL_COL, "recency_days", bins=40, clip=200.0, groups=(0, 1))


@register("recency_by_label", V(f"""SELECT {LABEL_COL}, COUNT(*) AS n,
  round_even(quantile_cont(CAST(recency_days AS DOUBLE), 0.5), 1) AS median,
  round_even(AVG(CAST(recency_days AS DOUBLE)), 1) AS mean
FROM model WHERE {LABEL_COL} IS NOT NULL GROUP BY 1 ORDER BY 1""", "tx_clean", "profile", extra=MODEL_CTES))
def q_recency_by_label(spark, sf):
    return S.group_center(study(spark, sf).model, LABEL_COL, "recency_days")


ENG_COLS = [m for m in S.ENGAGEMENT_METRICS if m in PROFILE_COLS]


@register("metric_means_by_segment", V("SELECT metric, customer_segment, mean FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS mpos, '{m}' AS metric, dom.customer_segment, dom.pos, round_even(g.m{i}, 2) AS mean "
    f"FROM dom LEFT JOIN g ON dom.customer_segment = g.customer_segment" for i, m in enumerate(ENG_COLS))
    + ") ORDER BY mpos, pos", "profile", extra=[DOM, (
        "g", "SELECT customer_segment, " + ", ".join(f"AVG(CAST({m} AS DOUBLE)) AS m{i}" for i, m in enumerate(ENG_COLS))
        + f" FROM profile WHERE {SEG_IN} GROUP BY 1")]))
def q_metric_means(spark, sf):
    return S.metric_means(Tables(spark, sf).profile, ORDER)


@register("daily_volume", V("""SELECT CAST(date AS DATE) AS date, COUNT(*) AS n_transactions
FROM tx_clean GROUP BY 1 ORDER BY 1""", "tx_clean"))
def q_daily(spark, sf):
    return S.daily_volume(study(spark, sf).tx_clean)


MONTHLY_SQL = """SELECT m.month, strftime(m.month, '%b') AS month_label, m.n_transactions,
  CAST(e.cop_usd_rate AS DOUBLE) AS cop_usd_rate,
  e.inflation_monthly_pct
FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS month, COUNT(*) AS n_transactions FROM tx_clean GROUP BY 1) m
LEFT JOIN econ e ON m.month = e.month"""


@register("monthly_volume_econ", V(MONTHLY_SQL + " ORDER BY 1", "tx_clean", "econ"))
def q_monthly_econ(spark, sf):
    t = Tables(spark, sf)
    return S.monthly_volume_econ(study(spark, sf).tx_clean, t.econ)


@register("strongest_month", V("""SELECT month, cop_usd_rate, n_transactions FROM mv WHERE cop_usd_rate IS NOT NULL
ORDER BY cop_usd_rate, month LIMIT 1""", "tx_clean", "econ", extra=[("mv", MONTHLY_SQL)]))
def q_strongest(spark, sf):
    t = Tables(spark, sf)
    return S.extreme_month(S.monthly_volume_econ(study(spark, sf).tx_clean, t.econ))


# == W: split and encoding =================================================================

@register("ordered_split", V("SELECT * FROM split_df", "tx_clean", "profile", extra=SPLIT_CTES))
def q_split(spark, sf):
    return study(spark, sf).split


@register("split_sizes", V("""SELECT split, n, round_even(n / SUM(n) OVER () * 100.0E0, 1) AS pct
FROM (SELECT split, COUNT(*) AS n FROM split_df GROUP BY 1)
ORDER BY CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END""", "tx_clean", "profile",
                           extra=SPLIT_CTES))
def q_split_sizes(spark, sf):
    return D.split_sizes(study(spark, sf).split)


ENCODER_SQL = " UNION ".join(
    f"SELECT '{c}' AS column_name, COALESCE(CAST({c} AS VARCHAR), 'None') AS value FROM split_df WHERE split = 'train'"
    for c in CAT_PRESENT)
ENC_CTES = SPLIT_CTES + [("cls", f"""SELECT column_name, value,
  CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS code FROM ({ENCODER_SQL})""")]


@register("encoder_classes", V("SELECT * FROM cls", "tx_clean", "profile", extra=ENC_CTES))
def q_encoder(spark, sf):
    return study(spark, sf).encoder


def _encoded_sql() -> str:
    fill = ", ".join(f"COALESCE(s.{c}, 0) AS {c}" for c in FILL_PRESENT)
    encs = ", ".join(f"COALESCE(e{i}.code, 0) AS {c}_enc" for i, c in enumerate(CAT_PRESENT))
    joins = " ".join(f"LEFT JOIN cls e{i} ON e{i}.column_name = '{c}' AND e{i}.value = COALESCE(CAST(s.{c} AS VARCHAR), 'None')"
                     for i, c in enumerate(CAT_PRESENT))
    return V(f"SELECT s.* REPLACE ({fill}), {encs} FROM split_df s {joins}", "tx_clean", "profile", extra=ENC_CTES)


@register("encoded_dataset", _encoded_sql())
def q_encoded(spark, sf):
    return study(spark, sf).encoded


@register("encoder_unseen", V(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE k.code IS NULL) AS n_unseen,
  round_even(COUNT(*) FILTER (WHERE k.code IS NULL) / COUNT(*) * 100.0E0, 2) AS unseen_pct
FROM split_df s LEFT JOIN cls k ON k.column_name = '{c}' AND k.value = COALESCE(CAST(s.{c} AS VARCHAR), 'None') WHERE s.split <> 'train'"""
    for c in CAT_PRESENT), "tx_clean", "profile", extra=ENC_CTES))
def q_encoder_unseen(spark, sf):
    return study(spark, sf).unseen


@register("encoded_from_store", _encoded_sql())
def q_encoded_from_store(spark, sf):
    """Fit, save, load, apply: the stored encoder gives the codes of the fitted one."""
    s = study(spark, sf)
    folder = scratch_folder(spark, "encoders")
    D.save_encoder(s.encoder, folder, 1)
    return D.apply_encoder(C.zero_fill(s.split, s.fill_zero), D.load_encoder(spark, folder), s.cat_cols, frozen=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.name: q.run for q in CATALOG}


def oracle_sql() -> dict[str, str]:
    return {q.name: q.sql for q in CATALOG if q.sql is not None}


# Further queries over other layouts of the same tables; they use the builders above.
from lapse.plans import catalog_stores, catalog_wide  # noqa: E402, F401
