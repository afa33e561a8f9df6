"""Joins that survive a hot key.

A left join whose right side is unique on the key needs no salting of both sides: only the few
keys that hold an outsized share of the left rows have to be kept out of the shuffle.  Their number
is bounded by ``1 / min_share`` whatever the data, so their right rows can be broadcast safely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, min_share: float = 0.01, min_rows: int = 10_000) -> list:
    """Keys that hold at least ``min_share`` of the rows of ``df`` and ``min_rows`` rows.

    Counts are combined on the map side, so a hot key costs one row per task in the shuffle.  At
    most ``1 / min_share`` keys can qualify, hence the list is small by construction.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.where(F.col("__n") >= F.lit(min_rows))
    rows = counts.orderBy(F.desc("__n"), key).limit(int(1 / min_share)).collect()
    if not rows:
        return []
    total = df.count()
    return [r[0] for r in rows if r["__n"] >= min_share * total]


def left_join_unique(left: DataFrame, right: DataFrame, key: str, min_share: float = 0.01, min_rows: int = 10_000) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` where ``right`` has at most one row for each key.

    Rows of ``left`` with a hot key are joined with the broadcast right rows of the hot keys (at
    most ``1 / min_share`` rows); all others, null keys included, go through the ordinary join.
    """
    hot = hot_keys(left, key, min_share, min_rows)
    if not hot:
        return left.join(right, key, "left")
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    few = F.broadcast(right.where(F.col(key).isin(hot)).limit(len(hot)))
    return left.where(~is_hot).join(right, key, "left").unionByName(left.where(is_hot).join(few, key, "left"))
