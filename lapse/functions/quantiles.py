"""Exact percentiles per group by bracket and select.

A mergeable sketch (``percentile_approx``, built inside the tasks) gives every
wanted percentile a bracket that holds it for certain: the sketch's rank error
is at most 1/ACCURACY of the rows, and the bracket reaches further by the ranks
that rounding and interpolation can add.  A second pass counts the rows between
the brackets and the equal values inside them; only the values inside are
sorted, about 8/ACCURACY of a large group's distinct values per percentile.  No
task holds a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.functions.materialize import sized_broadcast

ACCURACY = 10_000
# (least rows, reach): how far a bracket reaches on either side in groups below ACCURACY rows; a rank there is at
# least two of their rows.  In smaller groups it reaches over all rows.
SMALL_GROUPS = ((400, 0.01), (40, 0.1))


def exact_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float], name: str = "_q",
                    also: Sequence[Column] = (), few_groups: bool = False, accuracy: int = ACCURACY) -> DataFrame:
    """``(group, name, also...)``: array of linearly interpolated percentiles of the non-null values.

    ``value`` is a double column.  ``also`` are further aggregates of ``df`` per
    group, computed in the sketch's pass; with them a group without a value
    still has a row (and null percentiles).  Null groups give no row.  Say
    ``few_groups`` where a fixed list bounds the groups: brackets are broadcast
    unmeasured then, and nothing runs before the action.
    """
    rows = df.filter(F.col(group).isNotNull())
    ordered = sorted(set(probs))
    # Edges of every reach, lower and upper ones of all percentiles; a group takes those for its number of rows.
    reaches = [(accuracy, 4 / accuracy), *SMALL_GROUPS, (0, 1.0)]
    width = 2 * len(ordered)
    wanted = [min(1.0, max(0.0, p + side * reach)) for _, reach in reaches for p in ordered for side in (-1, 1)]
    level = F.coalesce(*[F.when(F.col("_total") >= least, F.lit(i)) for i, (least, _) in enumerate(reaches)])
    sketch = rows.groupBy(group).agg(F.count(value).alias("_total"), F.percentile_approx(value, wanted, accuracy).alias("_every"), *also)
    if not also:
        sketch = sketch.filter("_total > 0")
    sketch = sketch.withColumn("_edges", F.slice("_every", level * width + 1, F.lit(width))).drop("_every")
    if not few_groups:
        sketch = sized_broadcast(sketch)  # one row per group, written and measured: rows shuffle only past the limit
    lows, highs = range(0, width, 2), range(1, width, 2)

    # How many lower edges a value has reached, and how many upper edges it has passed: in a bracket where the first
    # is more.  Both only grow with the value, so equal counts are one stretch of the order.
    brackets = sketch.select(group, "_edges")
    x = F.col(value)
    located = rows.filter(x.isNotNull()).join(F.broadcast(brackets) if few_groups else brackets, group)
    reached = sum((F.when(x >= F.col("_edges")[i], 1).otherwise(0) for i in lows), F.lit(0))
    passed = sum((F.when(x > F.col("_edges")[i], 1).otherwise(0) for i in highs), F.lit(0))
    cells = (located.select(group, reached.alias("_lo"), passed.alias("_hi"), x.alias("_v"))
                    .groupBy(group, (F.col("_lo") + F.col("_hi")).alias("_stretch"), F.when(F.col("_lo") > F.col("_hi"), F.col("_v")).alias("_v"))
                    .agg(F.count(F.lit(1)).alias("_n")))
    upto = F.sum("_n").over(Window.partitionBy(group).orderBy("_stretch", "_v"))
    counted = cells.select(group, "_v", upto.alias("_upto")).join(
        F.broadcast(sketch.select(group, "_total")) if few_groups else sketch.select(group, "_total"), group)

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_total") - 1)

    def at_position(at: Column) -> Column:
        """The value of the first cell that reaches past the position; null would mean a row outside every bracket."""
        return F.min(F.when(F.col("_upto") > at, F.struct("_upto", "_v")))["_v"]

    bounds = [at_position(at(position(p))).alias(f"_{side}{i}")
              for i, p in enumerate(probs) for side, at in (("lo", F.floor), ("hi", F.ceil))]
    found = counted.groupBy(group, "_total").agg(*bounds)

    def between(i: int, p: float) -> Column:
        lo, hi, at = F.col(f"_lo{i}"), F.col(f"_hi{i}"), position(p)
        inside = F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi)
        return F.when(lo.isNull() | hi.isNull(), F.raise_error(F.lit("a percentile lies outside its bracket"))).otherwise(inside)

    quantiles = found.select(group, F.array(*[between(i, p) for i, p in enumerate(probs)]).alias(name))
    if not also:
        return quantiles
    return sketch.drop("_total", "_edges").join(F.broadcast(quantiles) if few_groups else quantiles, group, "left")
