"""Independent DuckDB SQL for each catalog query (the correctness oracle).

The view texts restate the input roles in SQL; every query is generated from
the same column lists and study windows the Spark side uses, so the two can
only differ in how they compute, not in what they are asked.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from lapse.config import StudyWindow
from lapse.sources.readers import COP_USD_RATE, INFLATION_MONTHLY_PCT

# Column order of the profile view (for the metadata queries).
PROFILE_COLUMNS = [
    ("customer_id", "bigint"), ("customer_segment", "string"), ("location", "string"),
    ("income_bracket", "string"), ("credit_card", "boolean"), ("credit_utilization_ratio", "double"),
    ("tx_count", "bigint"), ("avg_tx_value", "double"), ("total_tx_volume", "double"),
    ("first_tx", "timestamp_ntz"), ("last_tx", "timestamp_ntz"), ("support_tickets_count", "bigint"),
    ("resolved_tickets_ratio", "double"), ("failed_transactions", "bigint"), ("complaint_topics", "string"),
]
DOC_LABEL_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]

VIEWS = {
    "ledger": """SELECT o.o_custkey AS customer_id, l.l_shipdate AS date, l.l_extendedprice AS amount,
       l.l_returnflag AS type
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "tx_clean": "SELECT DISTINCT * FROM ledger",
    "ledger_dup": "SELECT user_id AS customer_id, CAST(ts AS DATE) AS date, event_type AS type FROM events",
    "ledger_intraday": "SELECT user_id AS customer_id, ts AS date, value AS amount, event_type AS type FROM events",
    "tx_intraday": "SELECT DISTINCT * FROM ledger_intraday",
    "profile": """SELECT c.c_custkey AS customer_id, c.c_mktsegment AS customer_segment, n.n_name AS location,
  CASE WHEN c.c_acctbal < 0 THEN 'Low' WHEN c.c_acctbal < 3000 THEN 'Medium'
       WHEN c.c_acctbal < 7000 THEN 'High' ELSE 'Very High' END AS income_bracket,
  c.c_acctbal > 0 AS credit_card,
  CASE WHEN c.c_acctbal > 0 THEN c.c_acctbal / 10000 END AS credit_utilization_ratio,
  COALESCE(t.tx_count, 0) AS tx_count, t.avg_tx_value, t.total_tx_volume, t.first_tx, t.last_tx,
  t.support_tickets_count, t.resolved_tickets_ratio, t.failed_transactions, t.complaint_topics
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (
  SELECT o_custkey, COUNT(*) AS tx_count,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice) AS avg_tx_value,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_tx_volume,
    MIN(o_orderdate) AS first_tx, MAX(o_orderdate) AS last_tx,
    COUNT(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS support_tickets_count,
    AVG(CASE WHEN o_orderpriority = '1-URGENT'
             THEN CASE WHEN o_orderstatus = 'F' THEN 1.0E0 ELSE 0.0E0 END END) AS resolved_tickets_ratio,
    COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS failed_transactions,
    MAX(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) AS complaint_topics
  FROM orders GROUP BY o_custkey) t ON c.c_custkey = t.o_custkey""",
    "doc_labels": """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
}
# Columns that the wide profile adds, in order.
WIDE_EXTRA = ["gender", "clv_segment", "feedback_sentiment", "satisfaction_score", "nps_score", "app_logins_frequency", "feature_usage_diversity",
              "app_store_rating", "feature_requests", "customer_tenure", "active_products", "customer_lifetime_value", "churn_probability",
              "average_transaction_value", "total_transaction_volume", "weekend_transaction_ratio", "last_transaction_date"]
# wide_raw holds NaN; wide reads it as null, as the study does.
VIEWS["wide_raw"] = """SELECT p.*,
  CASE WHEN p.customer_id % 3 = 0 THEN 'F' WHEN p.customer_id % 3 = 1 THEN 'M' END AS gender,
  CASE WHEN total_tx_volume >= 1500000 THEN 'High' WHEN total_tx_volume >= 1000000 THEN 'Medium' WHEN total_tx_volume IS NOT NULL THEN 'Low' END AS clv_segment,
  CASE WHEN resolved_tickets_ratio >= 0.6E0 THEN 'positive' WHEN resolved_tickets_ratio >= 0.4E0 THEN 'neutral'
       WHEN resolved_tickets_ratio IS NOT NULL THEN 'negative' END AS feedback_sentiment,
  e.satisfaction_score, e.nps_score, e.app_logins_frequency, e.feature_usage_diversity, e.app_store_rating, e.feature_requests,
  CAST(date_diff('day', CAST(first_tx AS DATE), CAST(last_tx AS DATE)) AS DOUBLE) AS customer_tenure, o.active_products,
  total_tx_volume / 10 AS customer_lifetime_value,
  CASE WHEN tx_count > 0 THEN failed_transactions / tx_count END AS churn_probability,
  avg_tx_value AS average_transaction_value, total_tx_volume AS total_transaction_volume, o.weekend_transaction_ratio,
  last_tx AS last_transaction_date
FROM profile p
LEFT JOIN (SELECT user_id, MAX(value) AS satisfaction_score, CASE WHEN user_id % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE MIN(value) END AS nps_score,
    CAST(COUNT(CASE WHEN event_type = 'view' THEN 1 END) AS DOUBLE) AS app_logins_frequency, CAST(COUNT(DISTINCT event_type) AS DOUBLE) AS feature_usage_diversity,
    CAST(COUNT(*) % 5 + 1 AS DOUBLE) AS app_store_rating, MAX(CASE WHEN event_type = 'signup' THEN props END) AS feature_requests
  FROM events GROUP BY user_id) e ON e.user_id = p.customer_id
LEFT JOIN (SELECT o_custkey, CAST(COUNT(DISTINCT o_orderpriority) AS DOUBLE) AS active_products,
    COUNT(CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 1 END) / COUNT(*) AS weekend_transaction_ratio
  FROM orders GROUP BY o_custkey) o ON o.o_custkey = p.customer_id"""
VIEWS["wide"] = "SELECT * REPLACE (CASE WHEN isnan(nps_score) THEN NULL ELSE nps_score END AS nps_score) FROM wide_raw"
VIEW_DEPS = {"tx_clean": ["ledger"], "tx_intraday": ["ledger_intraday"], "wide_raw": ["profile"], "wide": ["wide_raw"]}


def econ_view(start: str = "2000-01-01") -> str:
    d = dt.date.fromisoformat(start)
    rows = []
    for i, (rate, infl) in enumerate(zip(COP_USD_RATE, INFLATION_MONTHLY_PCT)):
        y, m = divmod(d.month - 1 + i, 12)
        rows.append(f"(DATE '{dt.date(d.year + y, m + 1, 1).isoformat()}', {rate}, {infl})")
    return ("SELECT CAST(month AS DATE) AS month, CAST(rate AS INTEGER) AS cop_usd_rate, "
            "CAST(infl AS DOUBLE) AS inflation_monthly_pct FROM (VALUES " + ", ".join(rows) +
            ") v(month, rate, infl)")


def with_views(body: str, *names: str, extra: Sequence[tuple[str, str]] = ()) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def add(n):
        for dep in VIEW_DEPS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [(n, econ_view() if n == "econ" else VIEWS[n]) for n in order] + list(extra)
    return "WITH " + ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in ctes) + "\n" + body


def wide_ctes() -> str:
    """The views behind ``wide`` as CTE text, for a body that names them itself."""
    return with_views("", "wide").removeprefix("WITH ")


def ts(value: dt.datetime) -> str:
    return f"TIMESTAMP '{value.strftime('%Y-%m-%d %H:%M:%S')}'"


def lit_list(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def domain_values(name: str, values: Sequence[str]) -> str:
    rows = ", ".join(f"('{v}', {i})" for i, v in enumerate(values))
    return f"SELECT * FROM (VALUES {rows}) d({name}, pos)"


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def exact_mean(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({expr})"


def pair_corr(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    a2 = f"CASE WHEN {both} THEN CAST({a} AS DOUBLE) END"
    b2 = f"CASE WHEN {both} THEN CAST({b} AS DOUBLE) END"
    return f"covar_pop({a2}, {b2}) / NULLIF(stddev_pop({a2}) * stddev_pop({b2}), 0)"


def self_corr(a: str) -> str:
    return f"CASE WHEN stddev_pop(CAST({a} AS DOUBLE)) > 0 THEN 1.0E0 END"


# -- feature SQL -------------------------------------------------------------------

def rfm_sql(src: str, w: StudyWindow) -> str:
    wide, mid = w.widest, w.days[-2]
    freqs = ",\n  ".join(f"COUNT(*) FILTER (WHERE date >= {ts(w.window_start(d))}) AS freq_{d}d"
                         for d in reversed(w.days))
    k = f"(CAST({wide} AS DOUBLE) / CAST({mid} AS DOUBLE))"
    fw, fm = f"CAST(freq_{wide}d AS DOUBLE)", f"CAST(freq_{mid}d AS DOUBLE)"
    return f"""SELECT customer_id, date_sub('day', last_date, {ts(w.cutoff)}) AS recency_days,
  {", ".join(f"freq_{d}d" for d in reversed(w.days))},
  COALESCE(value, 0.0E0) AS avg_value_{wide}d,
  round_even(({fm} - {fw} / {k}) / ({fw} / {k} + 1.0E0), 4) AS freq_{mid}d_change
FROM (
  SELECT customer_id, MAX(date) AS last_date,
  {freqs},
  {exact_mean(f"CASE WHEN date >= {ts(w.window_start(wide))} THEN amount END")} AS value
  FROM {src} WHERE date <= {ts(w.cutoff)} AND customer_id IS NOT NULL
  GROUP BY customer_id)"""


def label_sql(src: str, w: StudyWindow, label: str = "inactive_next_60d") -> str:
    pop = f"date >= {ts(w.pop_start)} AND date <= {ts(w.cutoff)}"
    tgt = f"date >= {ts(w.target_lo)} AND date <= {ts(w.target_hi)}"
    return f"""SELECT customer_id, CAST(1 - MAX(CASE WHEN {tgt} THEN 1 ELSE 0 END) AS INTEGER) AS {label}
FROM {src} WHERE customer_id IS NOT NULL AND (({pop}) OR ({tgt}))
GROUP BY customer_id HAVING MAX(CASE WHEN {pop} THEN 1 ELSE 0 END) = 1"""


def model_sql(exclude: Sequence[str]) -> str:
    have = {c for c, _ in PROFILE_COLUMNS}
    ex = [c for c in exclude if c in have]
    star = f"p.* EXCLUDE ({', '.join(ex)})" if ex else "p.*"
    return f"""SELECT {star}, r.* EXCLUDE (customer_id), lb.* EXCLUDE (customer_id)
FROM profile p JOIN rfm r ON p.customer_id = r.customer_id JOIN lbl lb ON p.customer_id = lb.customer_id"""


def split_sql(src: str, fractions=(0.70, 0.15), names=("train", "validation", "test")) -> str:
    n1 = f"floor(CAST(n AS DOUBLE) * {dbl(fractions[0])})"
    n2 = f"floor(CAST(n AS DOUBLE) * {dbl(fractions[1])})"
    return f"""SELECT * EXCLUDE (pos, n), CASE WHEN pos < {n1} THEN '{names[0]}'
  WHEN pos < {n1} + {n2} THEN '{names[1]}' ELSE '{names[2]}' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY recency_days, customer_id) - 1 AS pos, COUNT(*) OVER () AS n FROM {src})"""
