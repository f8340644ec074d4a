"""Schema-tolerant column helpers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, TimestampNTZType, TimestampType


def present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """The listed columns that exist in ``df``, in list order."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def bound(df: DataFrame, col: str, value: dt.datetime) -> Column:
    """A literal of ``col``'s own type, so comparisons stay pushable to the scan.

    Comparing a ``timestamp_ntz`` column with a session-zoned timestamp would
    cast the column and hide the predicate from the parquet reader.
    """
    dtype = df.schema[col].dataType
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(dtype, TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ '{text}'")
    if isinstance(dtype, TimestampType):
        return F.expr(f"TIMESTAMP '{text}'")
    if isinstance(dtype, DateType) and value.time() == dt.time(0):
        return F.expr(f"DATE '{value.date().isoformat()}'")
    raise TypeError(f"column {col} of type {dtype.simpleString()} cannot take bound {value}")


def str_class(df: DataFrame, col: str) -> Column:
    """Text form of a value as a label encoder sees it after ``astype(str)``.

    Null becomes ``'None'`` and booleans print as ``True`` / ``False``.
    """
    c = F.col(col)
    if isinstance(df.schema[col].dataType, BooleanType):
        text = F.initcap(c.cast("string"))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("None"))
