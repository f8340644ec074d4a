"""Reading raw files without losing rows: what fits the schema, and what does not with its reason.

A cell that does not parse as its column's type, a row with too few or too many
cells, and a date that is no date make a row a rejected row.  Rows are parsed in
one pass and written once, kept and rejected rows in folders of their own, so
both outputs come from one reading of the raw files and rows in = rows kept +
rows rejected always holds.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lapse.session import scratch_folder
from lapse.sources.readers import nan_to_null

RAW = "_corrupt_record"


def _as_schema(spark: SparkSession, schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema


def parsed_date(col: Column, fmt: str | None) -> Column:
    """Text as ``timestamp_ntz``, null where it is no date.  With a format the text is first tried, then parsed."""
    if fmt is None:
        return col.try_cast("timestamp_ntz")
    return F.when(F.try_to_timestamp(col, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(col, F.lit(fmt)))


def read_with_rejects(spark: SparkSession, path: str, schema: StructType | str, dates: Mapping[str, str | None] | None = None,
                      work_path: str | None = None, nan_as_null: bool = True, **options) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) of the CSV files at ``path``.

    ``schema`` gives names and types; text columns named in ``dates`` are parsed
    with the given format (null: Spark's own) and come out as ``timestamp_ntz``.
    Empty cells are nulls, not errors.  ``rejected`` has ``reason`` (``malformed``,
    or ``date: <column>``) and ``raw``, the line as read (for a bad date: the
    row's cells as a CSV line).  Both are read from ``work_path`` (a scratch
    folder of the session by default), where one job writes them.
    """
    schema = _as_schema(spark, schema)
    dates = dict(dates or {})
    names = [f.name for f in schema.fields]
    reader = spark.read.format("csv").schema(StructType(schema.fields).add(RAW, StringType(), True))
    given = {"header": "true", "enforceSchema": "false", **options}
    for key, value in given.items():
        reader = reader.option(key, value)
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW).load(path)

    reason = F.when(F.col(RAW).isNotNull(), F.lit("malformed"))
    cells = []
    for name in names:
        cell = F.col(f"`{name}`")
        if name in dates and isinstance(schema[name].dataType, StringType):
            date = parsed_date(cell, dates[name])
            reason = reason.when(cell.isNotNull() & date.isNull(), F.lit(f"date: {name}"))
            cells.append(date.alias(name))
        else:
            cells.append(cell.alias(name))
    line = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]))
    tagged = rows.select(*cells, reason.alias("_reason"), F.when(reason.isNotNull(), F.coalesce(F.col(RAW), line)).alias("_raw"))
    folder = work_path or scratch_folder(spark, "ingest")
    tagged.withColumn("_rejected", F.col("_reason").isNotNull()).write.partitionBy("_rejected").parquet(folder)

    stored = spark.read.schema(tagged.withColumn("_rejected", F.lit(True)).schema).parquet(folder)
    kept = stored.filter(~F.col("_rejected")).select(*[F.col(f"`{n}`") for n in names])
    rejected = stored.filter("_rejected").select(F.col("_reason").alias("reason"), F.col("_raw").alias("raw"))
    return (nan_to_null(kept) if nan_as_null else kept), rejected


def reject_summary(kept: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows kept (``outcome`` 'kept') and rows rejected per reason; ``n_rows`` adds up to the rows read."""
    whole = kept.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("kept").alias("outcome"), "n_rows")
    return whole.unionByName(rejected.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows")))
