"""Joins, ranks and selections that hold up under skew and size.

* `lookup_join` broadcasts the looked-up side only after its bytes were counted
  and otherwise salts the keys that hold more rows than a task should;
* `with_position` numbers rows in a global order without a single-task window;
* `nth_smallest` finds an order statistic from histograms, without a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from prosemill.session import cut_lineage, frozen

# A dimension of at most this many bytes is broadcast.
BROADCAST_BYTES = 64 << 20
# A key with more rows than this is split over tasks of about as many rows.
TASK_ROWS = 2_000_000


def _width(df: DataFrame) -> Column:
    """The bytes of a row, about: its strings and numbers and 16 for the row."""
    total = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            part = F.octet_length(c)
        elif isinstance(f.dataType, T.ArrayType):
            part = 8 * F.size(c)
        else:
            part = F.lit(8)
        total = total + F.coalesce(part, F.lit(0))
    return total.cast("long")


def table_bytes(df: DataFrame) -> int:
    """The bytes of all rows, about; each task sends one number."""
    return df.agg(F.sum(_width(df))).first()[0] or 0


def hot_keys(df: DataFrame, key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """(key, salts): keys with more than `task_rows` rows, and the tasks they are to fill."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return n.where(F.col(key).isNotNull() & (F.col("n") > task_rows)).select(
        key, F.ceil(F.col("n") / F.lit(task_rows)).cast("int").alias("_salts")
    )


def lookup_join(
    rows: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Join rows with a dimension that is unique on `key` (inner, left, left_semi, left_anti).

    The dimension's bytes are summed in its tasks first (hand in a table or a
    stored result, not a long computation); up to `max_bytes` it is broadcast.
    Beyond that both sides shuffle.  The rows of a key are counted map-side, and
    a key with more than `task_rows` of them is dealt over as many tasks as that
    takes, by the hash of the whole row; its one dimension row is copied to each.
    Rows without a key match nothing and are dealt over all tasks.
    """
    if table_bytes(dim.select(key) if how in ("left_semi", "left_anti") else dim) <= max_bytes:
        return rows.join(F.broadcast(dim), key, how)
    # at most rows / task_rows keys: a small table, which Spark broadcasts if it sees that it is
    hot = cut_lineage(hot_keys(rows.select(key), key, task_rows))
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    left = (
        rows.join(hot, key, "left")
        .withColumn(
            "_salt",
            F.when(F.col(key).isNull(), F.pmod(spread, F.lit(1 << 20)))
            .otherwise(F.pmod(spread, F.coalesce("_salts", F.lit(1))))
            .cast("int"),
        )
        .drop("_salts")
    )
    right = (
        dim.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return left.join(right, [key, "_salt"], how).drop("_salt")


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """`df` with its 0-based row number in a global order.

    Range-partitioned sort, then each partition's start is added to the place
    within the partition.  The sorted rows are checkpointed so that a retried
    task meets the same partitions; only one count per partition is gathered.
    """
    fixed = frozen(df.orderBy(*order))
    placed = fixed.withColumn("_part", F.spark_partition_id()).withColumn(
        "_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_start"),
        )
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, (F.col("_start") + F.col("_at")).cast("long"))
        .drop("_part", "_at", "_start")
    )


def with_running_total(
    df: DataFrame, order: Sequence[Column], weight: str, name: str = "upto"
) -> DataFrame:
    """`df` with the sum of `weight` over all rows up to and with its own, in a global order.

    As `with_position`; the sums inside a partition of the sorted rows are windows over it.
    """
    fixed = frozen(df.orderBy(*order))
    placed = fixed.withColumn("_part", F.spark_partition_id()).withColumn(
        "_at", F.monotonically_increasing_id()
    )
    starts = (
        placed.groupBy("_part")
        .agg(F.sum(weight).alias("_sum"))
        .select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_start"))
    )
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("_inside", F.sum(weight).over(inside))
        .join(F.broadcast(starts), "_part")  # one row for each task of the sort
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_part", "_at", "_start", "_inside")
    )


def nth_smallest(
    df: DataFrame, value: Column, n: int, span: tuple | None = None, bins: int = 4096,
    few: int = 10_000,
):
    """(v, below, equal): the n-th smallest value (1-based), the rows below it and equal to it.

    Narrows a histogram to the bin that holds the n-th row until that bin has
    few distinct values left to count.  Each round is one scan that shuffles at
    most `bins` rows per task.  `span` is a known (low, high) of the values.
    """
    scope = df.select(value.alias("v")).where(F.col("v").isNotNull())
    v = F.col("v")
    if n < 1:
        return None, 0, 0
    lo, hi = span or scope.agg(F.min("v"), F.max("v")).first()
    if lo is None:
        return None, 0, 0
    below, inside = 0, None
    while lo < hi and (inside is None or inside > few):
        if isinstance(lo, int):
            width = (hi - lo) // bins + 1
            b = F.expr(f"cast((v - {lo}L) div {width}L as int)")
        else:
            b = F.least(
                F.floor((v - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1)
            ).cast("int")
        hist = (
            scope.where(v.between(F.lit(lo), F.lit(hi)))
            .groupBy(b.alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .orderBy("b")
            .collect()
        )
        found = None
        for row in hist:
            if below + row.n >= n:
                found = row
                break
            below += row.n
        if found is None:
            return None, below, 0
        if (found.lo, found.hi, found.n) == (lo, hi, inside):
            # values too close for a finer histogram: step over the smallest one
            equal = scope.where(v == F.lit(lo)).count()
            if below + equal >= n:
                return lo, below, equal
            below += equal
            lo = scope.where((v > F.lit(lo)) & (v <= F.lit(hi))).agg(F.min("v")).first()[0]
            inside = found.n - equal
            continue
        lo, hi, inside = found.lo, found.hi, found.n
    counts = (
        scope.where(v.between(F.lit(lo), F.lit(hi)))
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("v")
        .collect()
    )
    for row in counts:
        if below + row.n >= n:
            return row.v, below, row.n
        below += row.n
    return None, below, 0
