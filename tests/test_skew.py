"""Hot keys: one recency value or one customer holding a third of the rows.

Inputs are derived from the given tables by Spark; results are checked
against a brute-force pandas computation on the same rows."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lapse.config import LEDGER_WINDOW
from lapse.operators import dataset as D
from lapse.operators import features as A
from lapse.sources.views import Tables
from tests.conftest import SF01


def test_split_with_a_hot_recency_value(spark):
    cust = Tables(spark, SF01).table("customer").select(F.col("c_custkey").alias("customer_id"))
    df = cust.select("customer_id",
                     F.when(F.col("customer_id") % 3 == 0, F.lit(0)).otherwise(F.col("customer_id") % 61).alias("recency_days"))
    got = D.ordered_split(df, rows_per_block=37).toPandas()
    pdf = df.toPandas().sort_values(["recency_days", "customer_id"]).reset_index(drop=True)
    n = len(pdf)
    n1, n2 = int(n * 0.70), int(n * 0.15)
    pdf["split"] = np.where(pdf.index < n1, "train", np.where(pdf.index < n1 + n2, "validation", "test"))
    merged = pdf.merge(got, on=["customer_id", "recency_days"], suffixes=("_exp", "_got"))
    assert len(merged) == n == len(got)
    assert (merged.split_exp == merged.split_got).all()


def test_features_with_a_hot_customer(spark):
    ledger = Tables(spark, SF01).ledger
    hot = ledger.withColumn("customer_id", F.when(F.xxhash64("date", "amount") % 3 == 0, F.lit(7)).otherwise(F.col("customer_id")))
    got = A.rfm_features(hot, LEDGER_WINDOW).filter("customer_id = 7").toPandas()
    pdf = hot.filter("customer_id = 7").toPandas()
    w = LEDGER_WINDOW
    obs = pdf[pdf.date <= pd.Timestamp(w.cutoff)]
    assert len(obs) > 1000  # a real hot key at this scale
    r = got.iloc[0]
    assert r.recency_days == (pd.Timestamp(w.cutoff) - obs.date.max()).days
    for d in w.days:
        assert r[f"freq_{d}d"] == (obs.date >= pd.Timestamp(w.window_start(d))).sum()
    in90 = obs[obs.date >= pd.Timestamp(w.window_start(90))].amount
    assert abs(r.avg_value_90d - in90.mean()) < 1e-6


def test_dedup_with_a_hot_group_of_copies(spark):
    """Copies of one row make up a third of the input: map-side combining
    merges them inside each task, and the result is still exact."""
    from lapse.operators import cleaning as C
    ledger = Tables(spark, SF01).ledger
    n = ledger.count()
    # replicate the first row n/2 times with an exploded counter (no join)
    first = ledger.orderBy(*ledger.columns).limit(1)
    reps = first.select("*", F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("_k")).drop("_k")
    hot = ledger.unionByName(reps)
    r = C.dedup_stats(hot).first()
    assert r.rows_before == n + n // 2
    assert r.rows_after == C.dedup_exact(ledger).count()
    assert C.dedup_exact(hot).count() == r.rows_after


def test_split_with_nearly_unique_order_values(spark):
    """Order values almost all distinct: the offsets take the ranged path and
    the positions still equal a plain sort."""
    cust = Tables(spark, SF01).table("customer").select(F.col("c_custkey").alias("customer_id"))
    score = ((F.col("customer_id") * 7919) % 1499).cast("double")
    df = cust.select("customer_id", F.when(F.col("customer_id") % 97 == 0, None).otherwise(score).alias("score"))
    got = D.ordered_split(df, order_col="score", rows_per_block=50).toPandas()
    pdf = df.toPandas().sort_values(["score", "customer_id"]).reset_index(drop=True)
    n = len(pdf)
    n1, n2 = int(n * 0.70), int(n * 0.15)
    pdf["split"] = np.where(pdf.index < n1, "train", np.where(pdf.index < n1 + n2, "validation", "test"))
    merged = pdf.merge(got, on="customer_id", suffixes=("_exp", "_got"))
    assert len(merged) == n == len(got)
    assert (merged.split_exp == merged.split_got).all()
