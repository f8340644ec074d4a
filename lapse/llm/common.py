"""Shared pieces of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The bytes that separate words everywhere in this package: space and \t \n \v \f \r.
WORD_GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Characters of text among which the language model draws.
BATCH_CHARS = 12_000_000
# Characters of text that a Python task gathers before it works on them together.  It holds many bytes a character
# meanwhile, and so does every other task of the executor, beside a JVM whose heap has grown to its limit.
TASK_CHARS = 6_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names that clash with none of ``df``'s (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name = stem
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as an array."""
    return F.array_remove(F.split(text, WORD_GAP), "")


def id_crc(name: str) -> Column:
    """crc32 of an id as text (a null id counts as the empty text, whose crc32 is 0)."""
    return F.crc32(F.coalesce(col(name).cast("string"), F.lit("")).cast("binary"))


def _texts(column, rows: int = 256) -> Iterator:
    """The column's values as Python objects, few at a time."""
    for i in range(0, len(column), rows):
        yield from column.slice(i, rows).to_pylist()


def text_batches(batches: Iterable, text_field: str = "text", limit: int = TASK_CHARS) -> Iterator[tuple[list, list]]:
    """Regroup Arrow batches so that each holds about ``limit`` characters: (record batches' other columns, texts).

    Yields (rows, texts) where rows is a list of (batch, first, last) slices.  A text is never cut;
    one longer than ``limit`` is a group of its own.  Between groups Arrow gives free memory back, as
    the worker lives on through the tasks and stages that follow.
    """
    import pyarrow as pa

    rows, texts, size = [], [], 0
    for batch in batches:
        column = batch.column(text_field)
        start = 0
        for i, text in enumerate(_texts(column)):
            text = text or ""
            if texts and size + len(text) > limit:
                if i > start:
                    rows.append((batch, start, i))
                yield rows, texts
                rows, texts, size, start = [], [], 0, i
                pa.default_memory_pool().release_unused()
            texts.append(text)
            size += len(text)
        if batch.num_rows > start:
            rows.append((batch, start, batch.num_rows))
    if texts:
        yield rows, texts
        rows, texts = [], []
        pa.default_memory_pool().release_unused()


def gathered(rows: list, field: str):
    """One Arrow array with ``field`` of all rows that ``text_batches`` put in a group."""
    import pyarrow as pa
    parts = [batch.column(field).slice(a, b - a) for batch, a, b in rows]
    return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)


def coded_words(texts: list[str], lower: bool = False):
    """Words (as in ``words``) of many texts, each distinct word once.

    Returns (distinct words as an Arrow binary array, which may hold an unused empty word, the number of every word in reading order,
    the index at which each text's words begin and, last, their count).  ``lower`` lower-cases A-Z.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    raw = (t.encode() for t in texts)
    # bytes.split() cuts at exactly the bytes of WORD_GAP, bytes.lower() changes exactly A-Z.
    joined = [b" ".join((t.lower() if lower else t).split()) for t in raw]
    lists = pc.split_pattern(pa.array(joined, type=pa.large_binary()), b" ")
    flat, starts = lists.flatten(), lists.offsets.to_numpy()
    empty = np.array([not j for j in joined], dtype=bool)
    coded = flat.dictionary_encode()
    numbers = coded.indices.to_numpy().astype(np.int64)
    if empty.any():  # the empty text splits into one empty word
        numbers = np.delete(numbers, starts[:-1][empty])
        starts = np.concatenate(([0], np.cumsum(np.diff(starts) - empty)))
    return coded.dictionary, numbers, starts


def per_text(values, starts):
    """Sum of each text's values, given the index at which its values begin."""
    import numpy as np
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[starts[1:]] - sums[starts[:-1]]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application (they may have no copy of it)."""
    import hashlib
    import tempfile
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    files = sorted(top.rglob("*.py"))
    name = hashlib.sha256(b"".join(f.read_bytes() for f in files)).hexdigest()[:12]
    path = Path(tempfile.mkdtemp(prefix="lapse-")) / f"{top.name}-{name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for f in files:
            archive.write(f, f.relative_to(top.parent).as_posix())
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def in_tasks(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the tasks."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)
