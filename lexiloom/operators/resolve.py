"""Picking among candidates: evidence in order, and abstaining where it does not decide.

Candidates are rows ``ref, title`` with whatever evidence has been joined to them; a picker keeps at
most one row for each reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.session import cut_lineage

#: Thresholds of the pickers.
COSINE_ABSTAIN, COSINE_MARGIN, SEE_COSINE, SEE_MARGIN, HOMONYM_MARGIN, FOOTPRINT_LEAST = 0.45, 0.02, 0.65, 0.05, 0.5, 5


def only(candidates: DataFrame, ref: str, where: Column | None = None) -> DataFrame:
    """The candidate of each reference that is the only one, among those that qualify."""
    kept = candidates if where is None else candidates.where(where)
    rest = [c for c in kept.columns if c != ref]
    counted = kept.groupBy(ref).agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct(*rest)).alias("__v"))
    return counted.where("__n = 1").select(ref, "__v.*")


def best_by_margin(candidates: DataFrame, ref: str, key: str, score: str, least: float, margin: float) -> DataFrame:
    """The best candidate of each reference if it scores ``least`` and leads by ``margin``; equal scores go by key."""
    order = Window.partitionBy(ref).orderBy(F.desc(score), key)
    top = candidates.withColumn("__k", F.row_number().over(order)).where("__k <= 2")
    best = top.groupBy(ref).agg(F.max(F.when(F.col("__k") == 1, F.col(key))).alias(key), F.max(F.when(F.col("__k") == 1, F.col(score))).alias(score), F.max(F.when(F.col("__k") == 2, F.col(score))).alias("__second"))
    return best.where((F.col(score) >= least) & (F.coalesce(F.col(score) - F.col("__second"), F.lit(1.0)) >= margin)).drop("__second")


def fish(candidates: DataFrame, ref: str, key: str, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Columns ``ref, key, method``: the pick of the first kind of evidence that singles one out.

    Each step is a score; it decides for a reference if exactly one candidate has the greatest score
    and that is above 0.  If none does, the key is null and the method ``abstain``.
    """
    out, left = None, cut_lineage(candidates)
    for name, score in steps:
        scored = left.withColumn("__s", F.coalesce(score.cast("double"), F.lit(0.0)))
        top = scored.withColumn("__m", F.max("__s").over(Window.partitionBy(ref))).where((F.col("__s") == F.col("__m")) & (F.col("__s") > 0))
        hit = top.groupBy(ref).agg(F.count(F.lit(1)).alias("__n"), F.min(key).alias(key)).where("__n = 1").select(ref, key, F.lit(name).alias("method"))
        hit = cut_lineage(hit)
        out = hit if out is None else out.unionByName(hit)
        left = left.join(hit.select(ref), ref, "left_anti")
    rest = left.select(ref).distinct().select(ref, F.lit(None).cast(candidates.schema[key].dataType).alias(key), F.lit("abstain").alias("method"))
    return out.unionByName(rest)


def override(resolved: DataFrame, ruled: DataFrame, ref: str, key: str) -> DataFrame:
    """Rulings ``ref, ruling`` come first; an empty ruling means that the reference stays unresolved."""
    joined = resolved.join(ruled.select(ref, F.col("ruling")), ref, "left")
    return joined.withColumn(key, F.when(F.col("ruling").isNull(), F.col(key)).when(F.col("ruling") == "", None).otherwise(F.col("ruling"))).drop("ruling")


def swapped(df: DataFrame, target: str, display: str, known: DataFrame) -> DataFrame:
    """``df`` with ``target`` and ``display`` exchanged where only the display is a known title."""
    t = known.select(F.upper("title").alias("__t"), F.lit(True).alias("__is")).distinct()
    joined = df.join(t.withColumnRenamed("__is", "__a"), F.upper(F.col(target)) == F.col("__t"), "left").drop("__t").join(t.withColumnRenamed("__is", "__b"), F.upper(F.col(display)) == F.col("__t"), "left").drop("__t")
    turn = F.col("__a").isNull() & F.col("__b").isNotNull()
    return joined.select(*[c for c in df.columns if c not in (target, display)], F.when(turn, F.col(display)).otherwise(F.col(target)).alias(target), F.when(turn, F.col(target)).otherwise(F.col(display)).alias(display), turn.alias("turned"))
