"""Range, as-of and interval joins as equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.operators.ordered import last_known


def range_join(ranges: DataFrame, points: DataFrame, keys: Sequence[str], start: str, end: str, point: str, width: int = 16) -> DataFrame:
    """Rows of ``points`` with the rows of ``ranges`` that hold them: equal keys, ``start <= point <= end``.

    The axis is cut into cells of ``width``; a range is joined in every cell it touches, so the join is
    an equi-join on keys and cell, and what a task holds is bounded by what one cell holds.
    """
    cells = F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))
    spread = ranges.where(F.col(start) <= F.col(end)).withColumn("__cell", F.explode(cells))
    placed = points.withColumn("__cell", F.floor(F.col(point) / width))
    return spread.join(placed, [*keys, "__cell"]).where(F.col(point).between(F.col(start), F.col(end))).drop("__cell")


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key by a total order; ties that remain are equal rows."""
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__v"))
    return chosen.select(*keys, "__v.*")


def asof(probes: DataFrame, marks: DataFrame, keys: Sequence[str], at: str, mark_at: str, value: str, out: str) -> DataFrame:
    """``probes`` with ``out``: the ``value`` of the last mark of the same keys at or before ``at``.

    Marks and probes are put in one order and the last value is carried forward; a mark precedes a
    probe at the same place, and of marks at one place the greatest value counts.  A hot key is spread
    over blocks (see ``ordered``).
    """
    columns = probes.columns
    left = probes.select(*[F.col(k) for k in keys], F.col(at).alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast(marks.schema[value].dataType).alias("__mark"), F.struct(*columns).alias("__row"))
    right = marks.select(*[F.col(k) for k in keys], F.col(mark_at).alias("__at"), F.lit(0).alias("__kind"), F.col(value).alias("__mark"), F.lit(None).cast(left.schema["__row"].dataType).alias("__row"))
    carried = last_known(left.unionByName(right), keys, ["__at", "__kind", "__mark"], F.col("__mark"), "__last")
    return carried.where("__kind = 1").select("__row.*", F.col("__last").alias(out))


def clip(spans: DataFrame, marks: DataFrame, keys: Sequence[str], start: str, end: str, mark: str, width: int = 16) -> DataFrame:
    """Marks inside ``(start, end)`` of each span, counted from the span's start, and the start itself at 0."""
    inside = range_join(spans, marks, keys, start, end, mark, width).where((F.col(mark) > F.col(start)) & (F.col(mark) <= F.col(end)))
    rebased = inside.select(*spans.columns, (F.col(mark) - F.col(start)).alias("offset"))
    return rebased.unionByName(spans.select(*spans.columns, F.lit(0).cast(rebased.schema["offset"].dataType).alias("offset")))
