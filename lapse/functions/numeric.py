"""Numeric helpers that keep results equal to numpy/pandas semantics.

* ``half_even``: numpy's ``round``: scale the binary double, round half to
  even, unscale.  ``F.round`` (half up) and ``F.bround`` (on the decimal text)
  both differ from it on binary ties.
* ``exact_mean`` / ``exact_sum``: money columns summed as decimals, so the sum
  does not depend on the order in which partitions are combined.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def half_even(col: Column, digits: int) -> Column:
    scale = float(10 ** digits)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def exact_sum(col: Column, precision: int = 18, scale: int = 2) -> Column:
    """Sum as decimals; a group with a value that ``scale`` digits do not hold is summed as doubles,
    so no digits are dropped and no large value ends the job."""
    money = col.try_cast(DecimalType(precision, scale))
    fits = F.bool_and(F.coalesce(money.cast("double") == col.cast("double"), col.isNull()))
    return F.when(F.coalesce(fits, F.lit(True)), F.sum(money).cast("double")).otherwise(F.sum(col.cast("double")))


def exact_mean(col: Column, precision: int = 18, scale: int = 2) -> Column:
    """Mean of a money column: the sum, then one double division."""
    return exact_sum(col, precision, scale) / F.count(col)


def pct(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole * 100`` rounded half-even, in that operation order."""
    return half_even(part / whole * F.lit(100.0), digits)


# -- SQL text -------------------------------------------------------------------
# Generated expressions over many columns are passed as SQL text: through the
# Column API each call is one JVM round trip.

def q(name: str) -> str:
    """Backquote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_literal(value: str) -> str:
    """A Spark SQL string literal for ``value``."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
