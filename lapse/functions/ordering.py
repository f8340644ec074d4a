"""Fixed category orders (pandas ``reindex``) as a small domain frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType


def domain(spark: SparkSession, name: str, values: Sequence[str]) -> DataFrame:
    """``(name, pos)`` rows for an ordered category list; size = len(values)."""
    schema = StructType([StructField(name, StringType(), False),
                         StructField("pos", IntegerType(), False)])
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], schema)


def reindex(grouped: DataFrame, key: str, values: Sequence[str], keep_pos: bool = False) -> DataFrame:
    """Keep only listed groups, add listed-but-absent groups as null rows, order.

    ``grouped`` should already be restricted to ``values`` (filter before the
    groupBy so the filter reaches the scan); then both sides hold at most
    ``len(values)`` rows.
    """
    dom = domain(grouped.sparkSession, key, values)
    # After this filter the right side has at most len(values) rows, a bound
    # known before any data is read; Catalyst also pushes it below the groupBy.
    listed = grouped.filter(F.col(key).isin(list(values)))
    out = dom.join(F.broadcast(listed), key, "left")
    out = out.orderBy("pos")
    return out if keep_pos else out.drop("pos")
