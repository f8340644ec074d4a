"""Global positions of ordered rows without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.functions.materialize import freeze

# Low bits of monotonically_increasing_id: the row's place in its partition.
PLACE = (1 << 33) - 1


def with_positions(df: DataFrame, *order: str, name: str = "_pos") -> DataFrame:
    """``df`` in ascending order of ``order`` with each row's 0-based position.

    Spark range-partitions the rows, sorts each part and writes them once with
    their places in the part; a position is that place plus the rows of earlier
    parts.  The parts' sizes (at most one number per shuffle partition) come to
    the driver and go back as an array literal, so reading the result needs no
    shuffle.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE))
    dealt = freeze(df.repartitionByRange(*order).sortWithinPartitions(*order)
                     .select(*df.columns, F.spark_partition_id().alias("_part"), place.alias("_place")))
    sizes = dict(dealt.groupBy("_part").count().collect())
    before = [0]
    for part in range(max(sizes, default=-1) + 1):
        before.append(before[-1] + sizes.get(part, 0))
    start = F.element_at(F.lit(before).cast("array<long>"), F.col("_part") + 1)
    return dealt.select(*df.columns, (start + F.col("_place")).alias(name))
