"""Readers: CSV / parquet scans, NaN handling, date parsing, the econ series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, FloatType, IntegerType, StringType,
                               StructField, StructType, TimestampNTZType, TimestampType)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn float NaN into SQL null so means, counts and correlations skip it.

    pandas treats NaN as missing; Spark's ``avg`` would return NaN instead.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | str | None = None, nan_as_null: bool = True,
               **options) -> DataFrame:
    """Scan a table.  CSV gets ``header=true``; with no schema it infers one.

    Passing an explicit ``schema`` skips the extra inference pass over the
    file, which matters at scale.  Nothing is remembered between reads: a table
    rewritten with other columns is read with those.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
        if schema is None:
            reader = reader.option("inferSchema", "true")
        else:  # the header must name the schema's columns
            reader = reader.option("enforceSchema", "false")
    if schema is not None:
        reader = reader.schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    df = reader.load(path)
    return nan_to_null(df) if nan_as_null else df


def parse_dates(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    """Make ``col`` a ``timestamp_ntz`` (strings parsed, dates kept as dates)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, (DateType, TimestampNTZType, TimestampType)):
        return df
    parsed = F.to_timestamp_ntz(F.col(col), F.lit(fmt)) if fmt else F.to_timestamp_ntz(F.col(col))
    return df.withColumn(col, parsed)


# The monthly COP/USD rate and monthly inflation (%) of the
# original study, January to December.
COP_USD_RATE = [4876, 4912, 4831, 4765, 4502, 4330, 4120, 4215, 4387, 4512, 4680, 4820]
INFLATION_MONTHLY_PCT = [1.3, 1.5, 1.2, 1.0, 0.9, 0.6, 0.5, 0.5, 0.7, 0.6, 0.5, 0.4]

ECON_SCHEMA = StructType([
    StructField("month", DateType(), False),
    StructField("cop_usd_rate", IntegerType(), False),
    StructField("inflation_monthly_pct", DoubleType(), False),
])


def econ_dimension(spark: SparkSession, start_month: str | dt.date = "2023-01-01") -> DataFrame:
    """The 12-row monthly economic series on consecutive month starts."""
    start = dt.date.fromisoformat(str(start_month)) if not isinstance(start_month, dt.date) else start_month
    rows = []
    for i, (rate, infl) in enumerate(zip(COP_USD_RATE, INFLATION_MONTHLY_PCT)):
        y, m = divmod(start.month - 1 + i, 12)
        rows.append((dt.date(start.year + y, m + 1, 1), rate, infl))
    return spark.createDataFrame(rows, ECON_SCHEMA)


LEDGER_SCHEMA = StructType([
    StructField("customer_id", StringType(), True),
    StructField("date", StringType(), True),
    StructField("amount", DoubleType(), True),
    StructField("type", StringType(), True),
])
