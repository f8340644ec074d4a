"""The ledger side of the study as a stream: new ledger files arrive, exact
duplicates are dropped, and daily (or monthly) row counts are emitted once
the watermark has passed the day.

State stays bounded: the dedup key contains the event-time column, so the
watermark evicts old keys; period counts are emitted in append mode and then
dropped from state.  Progress and state live in the query's checkpoint
location, so a restarted query (or a lost executor) resumes exactly.

Streaming deduplication is keyed by the whole row and Spark does no map-side
combining for it, so many identical copies inside one micro-batch would meet
in one task; ``dedup_stream(combine_in_tasks=True)`` merges copies per Arrow
batch first (the batch ``dedup_exact`` merges them per task natively).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_ledger_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                       max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Stream new files of a ledger directory (an explicit schema is required)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def _drop_batch_copies(batches):
    for pdf in batches:
        yield pdf.drop_duplicates()


def dedup_stream(stream: DataFrame, watermark: str, date: str = "date",
                 combine_in_tasks: bool = False) -> DataFrame:
    """Exact-duplicate removal over all columns with watermark-bounded state.

    Rows older than ``watermark`` behind the latest seen are dropped, as any
    bounded state must; so the caller names it.  A backfill needs one at least
    as long as its span, or the batch operators.

    The event time is cast to a session-zone timestamp for the watermark.
    ``combine_in_tasks`` merges identical copies inside each Arrow batch
    (``mapInPandas``, stateless) before the stateful shuffle, so a flood of
    copies of one row sends at most one per batch to its task; it moves every
    row through Python, so use it for feeds known to carry such floods.
    """
    ts = stream.withColumn(date, F.col(date).cast("timestamp"))
    if combine_in_tasks:
        ts = ts.mapInPandas(_drop_batch_copies, ts.schema)
    return ts.withWatermark(date, watermark).dropDuplicates(ts.columns)


def volume_stream(stream: DataFrame, date: str = "date") -> DataFrame:
    """Rows per calendar day, emitted in append mode once the watermark passes
    the day's end (the streaming form of ``daily_volume``).

    Months are a batch roll-up of the emitted days (``monthly_volume_econ``
    over the sink), since calendar months are not fixed-length windows.
    Event-time windows start at UTC midnight; run with the session time zone
    at UTC (as the study does) so the emitted dates are the ledger's days.
    """
    g = stream.groupBy(F.window(F.col(date), "1 day").alias("w"))
    return g.agg(F.count(F.lit(1)).alias("n_transactions")).select(
        F.to_date(F.col("w.start")).alias("date"), "n_transactions")


def start_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
               available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Write in append mode to files with a checkpoint (exactly-once file sink)."""
    w = df.writeStream.format(fmt).outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
