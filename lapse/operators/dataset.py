"""Model table, label shares, ordered split and the train-fitted label encoder."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapse.config import KEY_COL, LABEL_COL
from lapse.functions.columns import present, str_class
from lapse.functions.materialize import freeze, sized_broadcast
from lapse.functions.numeric import half_even, pct, sql_literal
from lapse.functions.ranking import with_positions

SPLIT_NAMES = ("train", "validation", "test")

# Categorical columns the study encodes.
CAT_COLS = ["income_bracket", "gender", "location", "customer_segment",
            "clv_segment", "feedback_sentiment"]


def model_dataset(profile: DataFrame, rfm: DataFrame, label: DataFrame | None = None,
                  key: str = KEY_COL, exclude: Sequence[str] = ()) -> DataFrame:
    """Profiles that have features and a label (inner joins on the key).

    Pass ``rfm_with_label`` output alone (features and label from one
    aggregation) for a single join; or separate ``rfm`` and ``label`` frames,
    which come out of aggregations keyed by ``key`` and so join without a new
    shuffle.  ``exclude`` drops profile columns that would leak post-cutoff
    information.
    """
    prof = profile.drop(*present(profile, exclude))
    feats = rfm if label is None else rfm.join(label, key, "inner")
    out = prof.join(feats, key, "inner")
    if "active_products" in out.columns:
        out = out.withColumn("active_products_count", F.col("active_products"))
    return out


def label_distribution(df: DataFrame, label: str = LABEL_COL) -> DataFrame:
    """Count and % (1 dp) per label value."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # An unpartitioned window over the per-value counts only (a handful of rows).
    total = F.sum("n").over(Window.partitionBy())
    return g.select(label, "n", half_even(F.col("n") / total * F.lit(100.0), 1).alias("pct")).orderBy(label)


def ordered_split(df: DataFrame, order_col: str = "recency_days", tie_col: str = KEY_COL,
                  fractions: tuple[float, float] = (0.70, 0.15), names: Sequence[str] = SPLIT_NAMES,
                  rows_per_block: int = 100_000, split_col: str = "split") -> DataFrame:
    """70/15/15 split by position after sorting on ``(order_col, tie_col)``.

    Sizes are ``int(n * 0.70)`` and ``int(n * 0.15)`` in binary floating
    point, the rest is the last part; ``tie_col`` (unique, any type) makes the
    order total.  Null order values sort last.

    Only the first rows of the second and third part matter.  Above
    ``rows_per_block`` rows the two key columns are range-partitioned into as
    many parts as the session shuffles to and written once; the parts' sizes
    say which part holds a boundary row, and that part alone is narrowed again
    until it is one block.  The boundary rows stay in Spark as a written table
    of two rows: the split compares every
    row's keys with them as scalar subqueries, so no key value passes through
    Python and any ordered type is compared as itself.  Full rows are neither
    shuffled, sorted nor numbered, and an order value that most rows share is
    cut by its ties like any other.
    """
    n = df.count()
    first, second = int(n * fractions[0]), int(n * fractions[1])
    if not n:
        return df.withColumn(split_col, F.lit(names[2])).select(*[c for c in df.columns if c != split_col], split_col)
    edges = _rows_at(df.select(F.col(order_col).alias("_o"), F.col(tie_col).alias("_t")), n, [first, first + second], rows_per_block)

    def before(position: int) -> Column:
        """Whether a row sorts before the row at ``position``."""
        if position >= n:
            return F.lit(True)
        edge = edges.where(F.col("_position") == position).select(F.struct("_o", "_t")).scalar()
        return _sorts_before(F.col(order_col), F.col(tie_col), edge["_o"], edge["_t"])

    split = F.when(before(first), names[0]).when(before(first + second), names[1]).otherwise(names[2])
    return df.withColumn(split_col, split).select(*[c for c in df.columns if c != split_col], split_col)


def _key_order() -> list[Column]:
    return [F.col("_o").asc_nulls_last(), F.col("_t").asc_nulls_first()]


def _ranged(keys: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The keys in range parts, written once, and each part's (number, rows): at most one pair per shuffle partition."""
    dealt = freeze(keys.repartitionByRange(*_key_order()).withColumn("_part", F.spark_partition_id()))
    return dealt, sorted((r["_part"], r["count"]) for r in dealt.groupBy("_part").count().collect())


def _rows_at(keys: DataFrame, n: int, positions: Sequence[int], rows_per_block: int) -> DataFrame:
    """(_o, _t, _position) of the keys at the given positions below ``n``, written once."""
    wanted = sorted({p for p in positions if p < n})
    if n <= rows_per_block:
        found = [_picked(keys, wanted, wanted)]
    else:
        dealt, sizes = _ranged(keys)
        found = [_picked(*_narrowed(dealt, sizes, p, rows_per_block), [p]) for p in wanted]
    return freeze(reduce(DataFrame.unionByName, found))


def _narrowed(keys: DataFrame, sizes: list[tuple[int, int]], position: int, rows_per_block: int) -> tuple[DataFrame, list[int]]:
    """The part that holds a position, ranged again while that makes it smaller, and the position in it."""
    for part, size in sizes:
        if position < size:
            break
        position -= size
    rows = keys.where(F.col("_part") == part).drop("_part")
    if size > rows_per_block:
        finer, finer_sizes = _ranged(rows)
        if max(n for _, n in finer_sizes) < size:
            return _narrowed(finer, finer_sizes, position, rows_per_block)
    return rows, [position]


def _picked(rows: DataFrame, places: Sequence[int], positions: Sequence[int]) -> DataFrame:
    """The rows at some places of one block, named by their positions; only the two keys of a block are sorted together."""
    placed = rows.repartition(1).sortWithinPartitions(*_key_order()).withColumn("_place", F.monotonically_increasing_id())
    name = F.coalesce(*[F.when(F.col("_place") == at, F.lit(p)) for at, p in zip(places, positions)], F.lit(-1))
    return placed.select("_o", "_t", name.cast("long").alias("_position")).where(F.col("_position") >= 0)


def _sorts_before(order: Column, tie: Column, edge_order: Column, edge_tie: Column) -> Column:
    """(order, tie) < (edge_order, edge_tie) with null order values last and null ties first."""
    less = F.coalesce(order < edge_order, order.isNotNull() & edge_order.isNull())
    tie_less = edge_tie.isNotNull() & F.coalesce(tie < edge_tie, F.lit(True))
    return less | (order.eqNullSafe(edge_order) & tie_less)


def split_sizes(df: DataFrame, split_col: str = "split", names: Sequence[str] = SPLIT_NAMES) -> DataFrame:
    """Rows per part and % (1 dp), in part order."""
    g = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(split_col))
    return (g.select(split_col, "n", half_even(F.col("n") / total * F.lit(100.0), 1).alias("pct"),
                     order.alias("_o"))
             .orderBy("_o").drop("_o"))


CLASS_SCHEMA = "column_name string, value string, code int"


def fit_encoder(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Label-encoder classes fitted on ``train``: ``(column_name, value, code)``.

    Values are the text form (null -> 'None', booleans 'True'/'False'), codes
    0..k-1 in sorted (byte) order.  The distinct classes are ranked by range
    parts and written once (``with_positions``): no task ranks more than one
    part, and reading the classes needs no further shuffle.  Without any listed
    column the table is empty.
    """
    cols = present(train, cols)
    if not cols:
        return train.sparkSession.createDataFrame([], CLASS_SCHEMA)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), str_class(train, c).alias("value"))
                                for c in cols]))
    placed = with_positions(train.select(pairs.alias("p")).select("p.*").distinct(), "column_name", "value")
    # One number per listed column.
    first = dict(placed.groupBy("column_name").agg(F.min("_pos")).collect())
    if not first:
        return placed.select("column_name", "value", F.col("_pos").cast("int").alias("code"))
    column_start = F.coalesce(*[F.when(F.col("column_name") == c, F.lit(n)) for c, n in first.items()])
    return placed.select("column_name", "value", (F.col("_pos") - column_start).cast("int").alias("code"))


def _with_codes(df: DataFrame, classes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with ``_<col>_code``, null where the class table lacks the value: one left join per column."""
    out = df.select("*", *[str_class(df, c).alias(f"_{c}_txt") for c in cols])
    for c in cols:
        cls = classes.filter(F.col("column_name") == c).select(
            F.col("value").alias(f"_{c}_txt"), F.col("code").alias(f"_{c}_code"))
        out = out.join(cls, f"_{c}_txt", "left")
    return out


def apply_encoder(df: DataFrame, classes: DataFrame, cols: Sequence[str], suffix: str = "_enc",
                  checked_broadcast: bool = True, frozen: bool = False) -> DataFrame:
    """Add ``<col>_enc`` codes; values unseen in training get code 0.

    One left join per column against its class list.  With
    ``checked_broadcast`` the class table is frozen (unless it is ``frozen``:
    read from a written table) and counted first, and the joins broadcast it
    when it is within the row limit, so the data side is never shuffled;
    otherwise AQE decides at run time.
    """
    cols = present(df, cols)
    if checked_broadcast:
        classes = sized_broadcast(classes, frozen=frozen)
    coded = _with_codes(df, classes, cols)
    return coded.select(*df.columns, *[F.coalesce(F.col(f"_{c}_code"), F.lit(0)).alias(c + suffix) for c in cols])


def unseen_counts(df: DataFrame, classes: DataFrame, cols: Sequence[str], frozen: bool = False) -> DataFrame:
    """Per listed column, in list order: rows, rows whose value the encoder never saw (they get code 0) and their % (2 dp)."""
    cols = present(df, cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, n_rows long, n_unseen long, unseen_pct double")
    coded = _with_codes(df, sized_broadcast(classes, frozen=frozen), cols)
    one = coded.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f"_{c}_code").isNull()).alias(f"_u{i}") for i, c in enumerate(cols)])
    items = ", ".join(f"{i}, {sql_literal(c)}, _rows, _u{i}" for i, c in enumerate(cols))
    long = one.selectExpr(f"stack({len(cols)}, {items}) AS (pos, column_name, n_rows, n_unseen)")
    return long.orderBy("pos").select("column_name", "n_rows", "n_unseen",
                                      F.when(F.col("n_rows") > 0, pct(F.col("n_unseen"), F.col("n_rows"), 2)).alias("unseen_pct"))


# -- stored encoders ------------------------------------------------------------

def save_encoder(classes: DataFrame, path: str, version: int) -> None:
    """Keep fitted classes as ``<path>/version=<version>``; a version that exists is never overwritten."""
    classes.select("column_name", "value", "code").write.mode("errorifexists").parquet(f"{path.rstrip('/')}/version={int(version)}")


def load_encoder(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The stored classes of ``version`` (the largest by default), ready for ``apply_encoder(..., frozen=True)``."""
    if version is None:
        version = spark.read.parquet(path).agg(F.max("version")).first()[0]
    return spark.read.schema(CLASS_SCHEMA).parquet(f"{path.rstrip('/')}/version={int(version)}")
