"""Ordered scans whose partitions may be arbitrarily large.

A window over a hot key puts all its rows into one task.  Here rows are range-partitioned by key and
order instead, so that a hot key spans many blocks; each block is scanned on its own and a carry
from the blocks before it is added.  A key that spans several blocks fills all but its first and
last, so there are at most ``2 * blocks`` carries, which is a proven bound for broadcasting them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.session import cut_lineage

BLOCK = "__block"


def _blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], blocks: int | None) -> tuple[DataFrame, int]:
    """``df`` in blocks that follow each other by key and order; the block numbers are written down."""
    count = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(count, *[F.col(c) for c in [*keys, *order]])
    return cut_lineage(ranged.withColumn(BLOCK, F.spark_partition_id())), count


def _with_carry(df: DataFrame, keys: Sequence[str], summary: DataFrame, carry: Column, count: int) -> DataFrame:
    """``df`` with the column ``__carry`` for the blocks of the keys that span several."""
    spans = Window.partitionBy(*keys)
    several = summary.withColumn("__spans", F.count(F.lit(1)).over(spans)).where(F.col("__spans") > 1)
    carries = several.withColumn("__carry", carry).select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(BLOCK).alias("__b"), "__carry")
    on = F.col(BLOCK) == F.col("__b")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return df.join(F.broadcast(carries.limit(2 * count + 2)), on, "left").drop("__b", *[f"__k_{k}" for k in keys])


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, blocks: int | None = None) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows of the same key before this one.

    Equivalent to ``sum(value) over (partition by keys order by order rows between unbounded
    preceding and 1 preceding)`` with 0 for the first row; ``order`` must be total within a key for
    the result to be defined.
    """
    rows, count = _blocks(df, keys, order, blocks)
    before = Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, BLOCK).agg(F.sum(value).alias("__total"))
    previous = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(out, F.coalesce(F.sum(value).over(before), F.lit(0)))
    joined = _with_carry(rows, keys, totals, F.sum("__total").over(previous), count)
    return joined.withColumn(out, F.col(out) + F.coalesce(F.col("__carry"), F.lit(0))).drop(BLOCK, "__carry")


def last_known(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str, blocks: int | None = None) -> DataFrame:
    """``df`` with ``out``: the last non-null ``value`` at or before this row within its key."""
    rows, count = _blocks(df.withColumn("__value", value), keys, order, blocks)
    upto = Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = F.max_by("__value", F.when(F.col("__value").isNotNull(), F.struct(*order)))
    ends = rows.groupBy(*keys, BLOCK).agg(whole.alias("__end"))
    previous = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(out, F.last("__value", ignorenulls=True).over(upto))
    joined = _with_carry(rows, keys, ends, F.last("__end", ignorenulls=True).over(previous), count)
    return joined.withColumn(out, F.coalesce(F.col(out), F.col("__carry"))).drop(BLOCK, "__carry", "__value")


def next_known(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str, blocks: int | None = None) -> DataFrame:
    """``df`` with ``out``: the first non-null ``value`` after this row within its key."""
    rows, count = _blocks(df.withColumn("__value", value), keys, order, blocks)
    after = Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    whole = F.min_by("__value", F.when(F.col("__value").isNotNull(), F.struct(*order)))
    starts = rows.groupBy(*keys, BLOCK).agg(whole.alias("__start"))
    following = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumn(out, F.first("__value", ignorenulls=True).over(after))
    joined = _with_carry(rows, keys, starts, F.first("__start", ignorenulls=True).over(following), count)
    return joined.withColumn(out, F.coalesce(F.col(out), F.col("__carry"))).drop(BLOCK, "__carry", "__value")


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, blocks: int | None = None) -> DataFrame:
    """``df`` with ``out``: the ``value`` of the row before within its key; null for the first."""
    rows, count = _blocks(df, keys, order, blocks)
    before = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    ends = rows.groupBy(*keys, BLOCK).agg(F.max_by(value, F.struct(*order)).alias("__end"))
    carried = F.lag("__end").over(Window.partitionBy(*keys).orderBy(BLOCK))
    rows = rows.withColumn("__first", F.row_number().over(before) == 1).withColumn(out, F.lag(value).over(before))
    joined = _with_carry(rows, keys, ends, carried, count)
    return joined.withColumn(out, F.when(F.col("__first"), F.col("__carry")).otherwise(F.col(out))).drop(BLOCK, "__carry", "__first")
