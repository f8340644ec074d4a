"""The input roles of the study, derived from the star-schema test tables.

* ``profile``: one row per customer with ledger-derived and service columns
* ``ledger``: one row per order line (customer_id, date, amount, type)
* ``ledger_dup``: a day-grain event ledger that carries exact duplicates
* ``ledger_intraday``: the event ledger with times of day
* ``wide_profile``: the profile with every column the study names, NaN among them
* ``doc_labels``: documents left-joined to their (partial) labels

Each view is a lazy DataFrame; Catalyst prunes the unused columns and pushes
filters on ``date`` down into the parquet scans.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.functions.numeric import exact_mean, exact_sum
from lapse.sources.readers import econ_dimension, nan_to_null, read_table

# The segment order used for the test profile.  DORMANT is not
# in the data and AUTOMOBILE is not in the list, on purpose (reindex test).
PROFILE_SEGMENT_ORDER = ["BUILDING", "DORMANT", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
# The segment order of the original study.
SEGMENT_ORDER = ["inactive", "occasional", "regular", "power"]
# First month of the economic series placed on the test ledger.
ECON_START = "2000-01-01"


class Tables:
    """Lazy access to the parquet tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.sf_dir}/{name}.parquet", "parquet", nan_as_null=False)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)

    # -- views ---------------------------------------------------------------
    @cached_property
    def ledger(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice", "l_returnflag")
        od = self.table("orders").select("o_orderkey", "o_custkey")
        return (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
                  .select(F.col("o_custkey").alias("customer_id"),
                          F.col("l_shipdate").alias("date"),
                          F.col("l_extendedprice").alias("amount"),
                          F.col("l_returnflag").alias("type")))

    @cached_property
    def ledger_dup(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").alias("customer_id"),
            F.to_date("ts").alias("date"),
            F.col("event_type").alias("type"))

    @cached_property
    def ledger_intraday(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").alias("customer_id"),
            F.col("ts").alias("date"),
            F.col("value").alias("amount"),
            F.col("event_type").alias("type"))

    @cached_property
    def profile(self) -> DataFrame:
        c = self.table("customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
        # nation is the fixed 25-row dimension: a known size bound.
        n = self.table("nation").select("n_nationkey", "n_name")
        o = self.table("orders")
        urgent = F.col("o_orderpriority") == "1-URGENT"
        filled = F.col("o_orderstatus") == "F"
        t = o.groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("tx_count"),
            exact_mean(F.col("o_totalprice")).alias("avg_tx_value"),
            exact_sum(F.col("o_totalprice")).alias("total_tx_volume"),
            F.min("o_orderdate").alias("first_tx"),
            F.max("o_orderdate").alias("last_tx"),
            F.count(F.when(urgent, 1)).alias("support_tickets_count"),
            F.avg(F.when(urgent, F.when(filled, 1.0).otherwise(0.0))).alias("resolved_tickets_ratio"),
            F.count(F.when(filled, 1)).alias("failed_transactions"),
            F.max(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))).alias("complaint_topics"),
        )
        bal = F.col("c_acctbal")
        joined = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "inner")
                   .join(t, c.c_custkey == t.o_custkey, "left"))
        return joined.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.col("n_name").alias("location"),
            F.when(bal < 0, "Low").when(bal < 3000, "Medium").when(bal < 7000, "High")
             .otherwise("Very High").alias("income_bracket"),
            (bal > 0).alias("credit_card"),
            F.when(bal > 0, bal / 10000).alias("credit_utilization_ratio"),
            F.coalesce(F.col("tx_count"), F.lit(0).cast("bigint")).alias("tx_count"),
            "avg_tx_value", "total_tx_volume", "first_tx", "last_tx",
            "support_tickets_count", "resolved_tickets_ratio", "failed_transactions",
            "complaint_topics",
        )

    @cached_property
    def wide_profile(self) -> DataFrame:
        """The profile with every column that the study names, read with NaN as null.

        Service scores come from the event table (customers without events have
        none; ``nps_score`` is NaN for some users there), value columns from the
        orders behind ``profile``.  Counts that a customer may lack are doubles.
        """
        base = self.profile
        events = self.table("events").groupBy(F.col("user_id").alias("customer_id")).agg(
            F.max("value").alias("satisfaction_score"),
            F.when(F.col("user_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.min("value")).alias("nps_score"),
            F.count(F.when(F.col("event_type") == "view", 1)).cast("double").alias("app_logins_frequency"),
            F.count_distinct("event_type").cast("double").alias("feature_usage_diversity"),
            (F.count(F.lit(1)) % 5 + 1).cast("double").alias("app_store_rating"),
            F.max(F.when(F.col("event_type") == "signup", F.col("props"))).alias("feature_requests"))
        orders = self.table("orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
            F.count_distinct("o_orderpriority").cast("double").alias("active_products"),
            (F.count(F.when(F.dayofweek("o_orderdate").isin(1, 7), 1)) / F.count(F.lit(1))).alias("weekend_transaction_ratio"))
        # Both sides hold one row per customer.
        wide = base.join(events, "customer_id", "left").join(orders, "customer_id", "left").select(
            base["*"],
            F.when(F.col("customer_id") % 3 == 0, "F").when(F.col("customer_id") % 3 == 1, "M").alias("gender"),
            F.when(F.col("total_tx_volume") >= 1500000, "High").when(F.col("total_tx_volume") >= 1000000, "Medium")
             .when(F.col("total_tx_volume").isNotNull(), "Low").alias("clv_segment"),
            F.when(F.col("resolved_tickets_ratio") >= 0.6, "positive").when(F.col("resolved_tickets_ratio") >= 0.4, "neutral")
             .when(F.col("resolved_tickets_ratio").isNotNull(), "negative").alias("feedback_sentiment"),
            "satisfaction_score", "nps_score", "app_logins_frequency", "feature_usage_diversity", "app_store_rating", "feature_requests",
            F.datediff("last_tx", "first_tx").cast("double").alias("customer_tenure"), "active_products",
            (F.col("total_tx_volume") / 10).alias("customer_lifetime_value"),
            F.when(F.col("tx_count") > 0, F.col("failed_transactions") / F.col("tx_count")).alias("churn_probability"),
            F.col("avg_tx_value").alias("average_transaction_value"), F.col("total_tx_volume").alias("total_transaction_volume"),
            "weekend_transaction_ratio", F.col("last_tx").alias("last_transaction_date"))
        return nan_to_null(wide)

    @cached_property
    def doc_labels(self) -> DataFrame:
        d = self.table("documents").select("doc_id", "lang", "source", "n_chars")
        lab = self.table("labels")
        return d.join(lab, "doc_id", "left").select("doc_id", "lang", "source", "n_chars", "quality", "toxic")

    @cached_property
    def econ(self) -> DataFrame:
        return econ_dimension(self.spark, ECON_START)
