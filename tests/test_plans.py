"""Physical-plan checks: pushdown, pruning, shuffle count, no Python UDFs."""

import pytest

from lapse.plans.catalog import queries
from tests.conftest import SF001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rfm_one_aggregation_exchange_after_dedup_and_pushdown(spark):
    df = queries()["rfm_features"](spark, SF001)
    p = plan(df)
    # one exchange for the exact dedup, one for the per-customer aggregation;
    # the ledger join itself broadcasts the small orders side at this scale
    assert p.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" not in p and "Window" not in p
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThanOrEqual(l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in p


def test_label_or_filter_reaches_scan(spark):
    p = plan(queries()["inactivity_label"](spark, SF001))
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(l_shipdate" in p
    # max() ignores duplicates, so Catalyst drops the dedup aggregate under the label
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in p


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_udf_in_any_plan(spark, name):
    p = plan(queries()[name](spark, SF001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in p, name


def test_split_is_a_comparison(spark):
    """No window and no exchange of full rows above the frozen model."""
    o = plan(queries()["ordered_split"](spark, SF001))
    assert "Window" not in o and "Exchange" not in o and "Sort" not in o


def test_correlation_is_one_aggregate_pass(spark):
    p = plan(queries()["correlation_matrix"](spark, SF001))
    # the profile view's orders aggregation and the one global correlation aggregate
    assert p.count("SortAggregate") + p.count("HashAggregate") + p.count("ObjectHashAggregate") <= 6


def test_model_table_scans_the_ledger_once(spark):
    p = plan(queries()["model_dataset"](spark, SF001))
    assert p.count("lineitem.parquet") == 1
    # features and label in one aggregation: one join, with the profile
    assert p.count("SortMergeJoin") + p.count("BroadcastHashJoin") <= 4  # ledger, nation, orders-agg, profile


def test_encoded_table_needs_no_shuffle(spark):
    p = plan(queries()["encoded_dataset"](spark, SF001))
    assert "Exchange" not in p.replace("BroadcastExchange", "")
    assert p.count("BroadcastHashJoin") == 3


def test_dedup_hashes_on_every_column_after_map_side_combine(spark):
    p = plan(queries()["dedup_exact"](spark, SF001))
    assert "hashpartitioning(customer_id" in p and "REPARTITION_BY_COL" not in p
    assert p.count("Exchange hashpartitioning") == 1
    # partial aggregation below the exchange merges copies inside each task
    below = p.split("Exchange hashpartitioning", 1)[1]
    assert "HashAggregate" in below


@pytest.mark.parametrize("name", ["segment_summary", "describe_by_segment", "boxplot_stats", "metric_means_by_segment"])
def test_segment_list_reaches_the_customer_scan(spark, name):
    p = plan(queries()[name](spark, SF001))
    assert "PushedFilters: [IsNotNull(c_mktsegment), In(c_mktsegment, [BUILDING,DORMANT" in p or \
           "In(c_mktsegment, [BUILDING,DORMANT,FURNITURE,HOUSEHOLD,MACHINERY" in p


def test_sized_broadcast_checks_the_row_count(spark):
    """Under the limit the frozen table carries a broadcast hint; over it,
    no hint (Spark's own size statistics still decide for small tables)."""
    from lapse.functions.materialize import sized_broadcast
    small = spark.range(20).withColumnRenamed("id", "k")

    def hinted(df):
        return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(sized_broadcast(small, max_rows=100))
    assert not hinted(sized_broadcast(small, max_rows=10))
