"""Materialization helpers: reliable checkpoints and size-checked broadcasts.

``freeze`` writes a DataFrame to the session's checkpoint dir (the shared
folder a cluster names in ``spark.checkpoint.dir``).  It cuts the lineage, so a
lost executor re-reads the written table instead of recomputing the plan.  A
scratch folder is used only on a local master; elsewhere a missing shared
folder is an error (see ``lapse.session.ensure_checkpoint_dir``).

``sized_broadcast`` hints a broadcast only for a table whose rows and bytes
are both within limits; above them the caller's join stays a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a lookup table may measure and still be broadcast.
BROADCAST_ROW_LIMIT = 2_000_000
BROADCAST_BYTE_LIMIT = 64 << 20


def freeze(df: DataFrame) -> DataFrame:
    from lapse.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def row_bytes(df: DataFrame):
    """A Column with the approximate bytes of a row: text as it is, 16 for any other column."""
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns]
    total = F.lit(0).cast("long")
    for size in sizes:
        total = total + size
    return total


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT,
                    max_bytes: int = BROADCAST_BYTE_LIMIT, frozen: bool = False) -> DataFrame:
    """``df`` (frozen first, unless the caller did) with a broadcast hint if it is small enough."""
    table = df if frozen else freeze(df)
    n, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(table)), F.lit(0))).first()
    return F.broadcast(table) if n <= max_rows and size <= max_bytes else table
