"""Queries over stored layouts: rejected rows, the monthly ledger, the bucketed tables.

Each writes its layout from the given tables into a scratch folder first and answers from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.operators import cleaning as C
from lapse.plans import oracle as O
from lapse.plans.catalog import (MODEL_CTES, PROFILE_EXCLUDE, TS, V, W, _integrity_sql, _window_counts_sql, register, study)
from lapse.session import scratch_folder
from lapse.sources.keyed_store import KeyedStore
from lapse.sources.ledger_store import LedgerStore
from lapse.sources.rejects import read_with_rejects, reject_summary
from lapse.sources.views import Tables

# == S: raw files with rows that do not fit =================================================

RAW_SCHEMA = "customer_id bigint, date string, amount double, type string"
# How the raw events are damaged on their way to CSV, by event_id: the first rule that holds.
DAMAGE = [("event_id % 83 = 0", "short line"), ("event_id % 79 = 0", "extra cell"), ("event_id % 97 = 0", "bad date"), ("event_id % 89 = 0", "bad amount")]
OUTCOME = "CASE " + " ".join(f"WHEN {rule} THEN '{'date: date' if what == 'bad date' else 'malformed'}'" for rule, what in DAMAGE) + " ELSE 'kept' END"


def raw_event_lines(spark: SparkSession, sf: str) -> str:
    """The events as CSV lines, some of them damaged; returns their folder."""
    events = Tables(spark, sf).table("events")
    cells = {"customer_id": "CAST(user_id AS STRING)", "date": "CAST(ts AS STRING)", "amount": "CAST(value AS STRING)", "type": "event_type"}

    def line(**changed) -> str:
        return f"concat_ws(',', {', '.join({**cells, **changed}.values())})"

    damaged = {"short line": "concat_ws(',', user_id, ts)", "extra cell": f"concat({line()}, ',more')",
               "bad date": line(date="'31/31/2024'"), "bad amount": line(amount="'n/a'")}
    cases = " ".join(f"WHEN {rule} THEN {damaged[what]}" for rule, what in DAMAGE)
    folder = scratch_folder(spark, "raw-events")
    events.selectExpr(f"CASE {cases} ELSE {line()} END AS value").write.text(folder)
    return folder


def ingest(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return read_with_rejects(spark, raw_event_lines(spark, sf), RAW_SCHEMA, {"date": None}, header="false")


@register("ingest_kept", f"""SELECT user_id AS customer_id, ts AS date, value AS amount, event_type AS type FROM events
WHERE {OUTCOME} = 'kept'""")
def q_ingest_kept(spark, sf):
    return ingest(spark, sf)[0]


@register("ingest_summary", f"SELECT {OUTCOME} AS outcome, COUNT(*) AS n_rows FROM events GROUP BY 1")
def q_ingest_summary(spark, sf):
    return reject_summary(*ingest(spark, sf))


# == D: the monthly ledger ==================================================================

def ledger_store(spark: SparkSession, sf: str) -> LedgerStore:
    return LedgerStore.create(Tables(spark, sf).ledger, scratch_folder(spark, "ledger"))


@register("stored_target_rows", V(f"SELECT * FROM tx_clean WHERE date >= {TS(W.target_lo)} AND date <= {TS(W.target_hi)}", "tx_clean"))
def q_stored_target(spark, sf):
    return ledger_store(spark, sf).target_window(W)


@register("stored_window_counts", _window_counts_sql("tx_clean", W))
def q_stored_window_counts(spark, sf):
    return ledger_store(spark, sf).window_counts(W)


@register("stored_monthly_counts", V("""SELECT CAST(date_trunc('month', date) AS DATE) AS month, COUNT(*) AS n_rows
FROM tx_clean GROUP BY 1 ORDER BY 1""", "tx_clean"))
def q_stored_monthly(spark, sf):
    return ledger_store(spark, sf).monthly_counts()


@register("stored_daily_volume", V(f"""SELECT CAST(date AS DATE) AS date, COUNT(*) AS n_transactions
FROM tx_clean WHERE date >= {TS(W.pop_start)} AND date <= {TS(W.cutoff)} GROUP BY 1 ORDER BY 1""", "tx_clean"))
def q_stored_daily(spark, sf):
    return ledger_store(spark, sf).daily_volume(W.pop_start, W.cutoff)


@register("stored_append_dedup", V("SELECT DISTINCT * FROM ledger_dup", "ledger_dup"))
def q_stored_append(spark, sf):
    """The ledger arrives as two files that share rows; the second touches some months again."""
    ledger = Tables(spark, sf).ledger_dup
    late = F.col("date") >= F.lit("2024-01-10").cast("date")
    store = LedgerStore.create(ledger.filter(~late | (F.col("customer_id") % 2 == 0)), scratch_folder(spark, "ledger"))
    store.append(ledger.filter(late))
    return store.rows()


@register("stored_append_months", V("SELECT DISTINCT * FROM ledger WHERE date >= TIMESTAMP '1999-01-01'", "ledger"))
def q_stored_append_months(spark, sf):
    """Many months; only those from 2001 on are rewritten by the second file."""
    ledger = Tables(spark, sf).ledger.filter(F.col("date") >= F.expr("TIMESTAMP_NTZ '1999-01-01 00:00:00'"))
    new = F.col("date") >= F.expr("TIMESTAMP_NTZ '2001-01-01 00:00:00'")
    store = LedgerStore.create(ledger.filter(~new | (F.col("customer_id") % 3 > 0)), scratch_folder(spark, "ledger"))
    store.append(ledger.filter(new))
    return store.rows()


# == A, J: bucketed tables ==================================================================

def keyed_store(spark: SparkSession, sf: str) -> KeyedStore:
    s = study(spark, sf)
    return KeyedStore.create(C.exclude_columns(s.profile, PROFILE_EXCLUDE), s.tx_clean)


@register("keyed_recency", V(f"""SELECT customer_id, MAX(date) AS last_tx_date, date_sub('day', MAX(date), {TS(W.cutoff)}) AS recency_days
FROM tx_clean WHERE date <= {TS(W.cutoff)} AND customer_id IS NOT NULL GROUP BY customer_id""", "tx_clean"))
def q_keyed_recency(spark, sf):
    return keyed_store(spark, sf).recency(W)


_RECENT = f"date <= {TS(W.cutoff)} AND date >= {TS(W.window_start(W.widest))} AND customer_id IS NOT NULL"


@register("keyed_frequency", V("SELECT customer_id, " + ", ".join(
    f"COUNT(*) FILTER (WHERE date >= {TS(W.window_start(d))}) AS freq_{d}d" for d in reversed(W.days))
    + f" FROM tx_clean WHERE {_RECENT} GROUP BY customer_id", "tx_clean"))
def q_keyed_frequency(spark, sf):
    return keyed_store(spark, sf).frequency(W)


@register("keyed_avg_value", V(f"SELECT customer_id, {O.exact_mean('amount')} AS avg_value_90d FROM tx_clean WHERE {_RECENT} GROUP BY customer_id", "tx_clean"))
def q_keyed_avg_value(spark, sf):
    return keyed_store(spark, sf).average_value(W)


@register("keyed_rfm_features", V("SELECT * FROM rfm", "tx_clean", extra=[("rfm", O.rfm_sql("tx_clean", W))]))
def q_keyed_rfm(spark, sf):
    return keyed_store(spark, sf).rfm(W)


@register("keyed_inactivity_label", V("SELECT * FROM lbl", "tx_clean", extra=[("lbl", O.label_sql("tx_clean", W))]))
def q_keyed_label(spark, sf):
    return keyed_store(spark, sf).label(W)


@register("keyed_model_dataset", V("SELECT * FROM model", "tx_clean", "profile", extra=MODEL_CTES))
def q_keyed_model(spark, sf):
    return keyed_store(spark, sf).model(W)


@register("keyed_referential_integrity", _integrity_sql("profile", "tx_clean"))
def q_keyed_integrity(spark, sf):
    return keyed_store(spark, sf).referential_integrity()


@register("keyed_keys_in_both", V("""SELECT customer_id FROM profile WHERE customer_id IS NOT NULL
INTERSECT SELECT customer_id FROM tx_clean WHERE customer_id IS NOT NULL""", "profile", "tx_clean"))
def q_keyed_both(spark, sf):
    return keyed_store(spark, sf).keys_in_both()


@register("keyed_customers_without_tx", V("""SELECT customer_id FROM profile WHERE customer_id IS NOT NULL
EXCEPT SELECT customer_id FROM tx_clean""", "profile", "tx_clean"))
def q_keyed_without(spark, sf):
    return keyed_store(spark, sf).keys_without()
