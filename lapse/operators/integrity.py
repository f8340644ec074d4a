"""Key-set checks between a parent table (profiles) and a child table (ledger).

Both sides are reduced to distinct non-null keys first (partial aggregation
before the shuffle), then one full outer join on co-partitioned keys yields
every count in a single pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(df: DataFrame, key: str, flag: str) -> DataFrame:
    return (df.select(F.col(key).alias("key")).filter(F.col("key").isNotNull())
              .distinct().withColumn(flag, F.lit(True)))


def referential_integrity(parents: DataFrame, children: DataFrame,
                          parent_key: str = "customer_id", child_key: str = "customer_id") -> DataFrame:
    """Distinct keys per side, keys in both, keys on one side only, and a verdict."""
    j = _keys(parents, parent_key, "_p").join(_keys(children, child_key, "_c"), "key", "full")
    p, c = F.col("_p").isNotNull(), F.col("_c").isNotNull()
    agg = j.agg(F.count_if(p).alias("n_parent_keys"), F.count_if(c).alias("n_child_keys"),
                F.count_if(p & c).alias("n_both"), F.count_if(p & ~c).alias("n_parent_only"),
                F.count_if(c & ~p).alias("n_child_only"))
    verdict = (F.when((F.col("n_parent_only") == 0) & (F.col("n_child_only") == 0), "complete")
                .when(F.col("n_parent_only") > 0, "parents_without_children")
                .otherwise("children_without_parent"))
    return agg.withColumn("verdict", verdict)


def keys_in_both(parents: DataFrame, children: DataFrame,
                 parent_key: str = "customer_id", child_key: str = "customer_id") -> DataFrame:
    """Distinct keys present on both sides (INTERSECT DISTINCT)."""
    a = parents.select(F.col(parent_key).alias(parent_key)).filter(F.col(parent_key).isNotNull())
    b = children.select(F.col(child_key).alias(parent_key)).filter(F.col(parent_key).isNotNull())
    return a.intersect(b)


def keys_without(parents: DataFrame, children: DataFrame,
                 parent_key: str = "customer_id", child_key: str = "customer_id") -> DataFrame:
    """Distinct parent keys with no child row (EXCEPT DISTINCT, a left anti join)."""
    a = parents.select(F.col(parent_key).alias(parent_key)).filter(F.col(parent_key).isNotNull())
    b = children.select(F.col(child_key).alias(parent_key))
    return a.subtract(b)
