"""The profile operators on the wide profile: all the columns that the study names, NaN among them."""

from __future__ import annotations

from lapse.config import LABEL_COL
from lapse.operators import cleaning as C
from lapse.operators import dataset as D
from lapse.operators import features as A
from lapse.operators import profiling as P
from lapse.operators import summaries as S
from lapse.plans import oracle as O
from lapse.plans.catalog import (DOM, ORDER, PROFILE_COLS, SEG_IN, V, W, _corr_agg, _corr_pairs_sql, _exclusion_sql, _missing_sql, register)
from lapse.plans.study import Study
from lapse.sources.views import Tables

WIDE_COLS = PROFILE_COLS + O.WIDE_EXTRA
VIEW = "wide"
# Columns of the model that risk correlations use, in list order.
WIDE_MODEL_COLS = [c for c in WIDE_COLS if c not in C.GROUP_B_COLS] + [
    "recency_days", "freq_90d", "freq_30d", "freq_7d", "avg_value_90d", "freq_30d_change", LABEL_COL]
WIDE_MODEL = [("rfm", O.rfm_sql("tx_clean", W)), ("lbl", O.label_sql("tx_clean", W)),
              ("model", f"""SELECT p.* EXCLUDE ({', '.join(C.GROUP_B_COLS)}), r.* EXCLUDE (customer_id), lb.* EXCLUDE (customer_id),
  p.active_products AS active_products_count
FROM wide p JOIN rfm r ON p.customer_id = r.customer_id JOIN lbl lb ON p.customer_id = lb.customer_id""")]
WIDE_SPLIT = WIDE_MODEL + [("split_df", O.split_sql("model"))]


def wide_study(spark, sf) -> Study:
    t = Tables(spark, sf)
    return Study(t.wide_profile, t.ledger, W, exclude=C.GROUP_B_COLS)


@register("wide_missing_audit", _missing_sql(VIEW, WIDE_COLS, P.STRUCTURAL_COLS))
def q_missing(spark, sf):
    return P.missing_audit(Tables(spark, sf).wide_profile)


@register("wide_structural_missing_check", V(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, {f"'{flag}'" if flag else 'CAST(NULL AS VARCHAR)'} AS flag_column,
  CAST({f"COUNT(*) FILTER (WHERE NOT {flag})" if flag else 'NULL'} AS DOUBLE) AS flag_false_count, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM wide"""
    for c, flag in P.STRUCTURAL_FLAGS.items()), VIEW))
def q_structural(spark, sf):
    return P.structural_missing_check(Tables(spark, sf).wide_profile)


@register("wide_segment_summary", V(f"""SELECT dom.customer_segment, g.* EXCLUDE (customer_segment) FROM dom LEFT JOIN (
  SELECT customer_segment, CAST(COUNT(customer_id) AS DOUBLE) AS customer_count,
    {', '.join(f"round_even(AVG(CAST({m} AS DOUBLE)), 2) AS {P.mean_name(m)}" for m in P.SEGMENT_METRICS)}
  FROM wide WHERE {SEG_IN} GROUP BY customer_segment) g ON dom.customer_segment = g.customer_segment""", VIEW, extra=[DOM]))
def q_segment_summary(spark, sf):
    return P.segment_summary(Tables(spark, sf).wide_profile, ORDER)


@register("wide_correlation_matrix", V("SELECT feature_a, feature_b, corr FROM pairs", VIEW, extra=[
    ("cagg", _corr_agg(VIEW, P.CORR_FEATURES, True)), ("pairs", _corr_pairs_sql(P.CORR_FEATURES, 3, True, True))]))
def q_corr(spark, sf):
    return P.correlation_matrix(Tables(spark, sf).wide_profile)


@register("wide_correlation_top_pairs", V("""SELECT CAST(rank AS INTEGER) AS rank, feature_a, feature_b, corr FROM (
  SELECT *, row_number() OVER (ORDER BY raw DESC, pos_a, pos_b) AS rank FROM pairs WHERE corr IS NOT NULL) WHERE rank <= 10""", VIEW, extra=[
    ("cagg", _corr_agg(VIEW, P.CORR_FEATURES, False)), ("pairs", _corr_pairs_sql(P.CORR_FEATURES, 3, False, False))]))
def q_corr_top(spark, sf):
    return P.correlation_pairs(Tables(spark, sf).wide_profile, k=10)


@register("wide_exclusion_report", "WITH " + O.wide_ctes() + _exclusion_sql("SELECT * FROM wide", C.GROUP_B_COLS, WIDE_COLS))
def q_exclusion(spark, sf):
    return C.exclusion_report(Tables(spark, sf).wide_profile, C.GROUP_B_COLS)


@register("wide_exclude_columns", V(f"SELECT * EXCLUDE ({', '.join(C.GROUP_B_COLS)}) FROM wide", VIEW))
def q_exclude(spark, sf):
    return C.exclude_columns(Tables(spark, sf).wide_profile, C.GROUP_B_COLS)


@register("wide_metric_means", V(" UNION ALL ".join(
    f"SELECT '{m}' AS metric, dom.customer_segment, round_even(g.m{i}, 2) AS mean FROM dom LEFT JOIN g ON dom.customer_segment = g.customer_segment"
    for i, m in enumerate(S.ENGAGEMENT_METRICS)), VIEW, extra=[DOM, (
        "g", "SELECT customer_segment, " + ", ".join(f"AVG(CAST({m} AS DOUBLE)) AS m{i}" for i, m in enumerate(S.ENGAGEMENT_METRICS))
        + f" FROM wide WHERE {SEG_IN} GROUP BY 1")]))
def q_metric_means(spark, sf):
    return S.metric_means(Tables(spark, sf).wide_profile, ORDER)


@register("wide_model_dataset", V("SELECT * FROM model", "tx_clean", VIEW, extra=WIDE_MODEL))
def q_model(spark, sf):
    return wide_study(spark, sf).model


RISK = [c for c in S.RISK_FEATURES if c in WIDE_MODEL_COLS]


@register("wide_risk_correlation", V("SELECT feature_b AS feature_row, feature_a AS feature_col, corr FROM pairs", "tx_clean", VIEW, extra=WIDE_MODEL + [
    ("cagg", _corr_agg("model", RISK, False)), ("pairs", _corr_pairs_sql(RISK, 2, False, False))]))
def q_risk(spark, sf):
    return P.correlation_lower(wide_study(spark, sf).model, S.RISK_FEATURES, digits=2)


WIDE_ENCODED = WIDE_SPLIT + [("cls", "SELECT column_name, value, CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS code FROM ("
                              + " UNION ".join(f"SELECT '{c}' AS column_name, COALESCE(CAST({c} AS VARCHAR), 'None') AS value FROM split_df WHERE split = 'train'"
                                               for c in D.CAT_COLS) + ")")]


@register("wide_encoder_classes", V("SELECT * FROM cls", "tx_clean", VIEW, extra=WIDE_ENCODED))
def q_classes(spark, sf):
    return wide_study(spark, sf).encoder


@register("wide_encoded_dataset", V("SELECT s.* REPLACE (" + ", ".join(f"COALESCE(s.{c}, 0) AS {c}" for c in C.FILL_ZERO_COLS) + "), "
                                    + ", ".join(f"COALESCE(e{i}.code, 0) AS {c}_enc" for i, c in enumerate(D.CAT_COLS)) + " FROM split_df s "
                                    + " ".join(f"LEFT JOIN cls e{i} ON e{i}.column_name = '{c}' AND e{i}.value = COALESCE(CAST(s.{c} AS VARCHAR), 'None')"
                                               for i, c in enumerate(D.CAT_COLS)), "tx_clean", VIEW, extra=WIDE_ENCODED))
def q_encoded(spark, sf):
    return wide_study(spark, sf).encoded


@register("wide_feature_stats", V("SELECT feature, mean_value, min_value, max_value FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round_even(AVG(CAST({c} AS DOUBLE)), 2) AS mean_value, CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value FROM wide"
    for c in P.CORR_FEATURES) + ")", VIEW))
def q_feature_stats(spark, sf):
    return A.feature_stats(Tables(spark, sf).wide_profile, P.CORR_FEATURES)
