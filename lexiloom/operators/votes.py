"""Aggregates that choose, with ties broken by content and never by the order of reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mode(df: DataFrame, keys: Sequence[str], value: str, first: Column, out: str) -> DataFrame:
    """The commonest ``value`` of each key; of equally common ones the one met first, then the least.

    Values are counted before they are compared, so a hot key costs one row for each of its values.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"), F.min(first).alias("__first"))
    return counted.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("__n"), F.col("__first"), F.col(value))).alias(out), F.sum("__n").alias("votes"))


def unambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that have exactly one value, with it."""
    found = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("__max"))
    return found.where(F.col(value) == F.col("__max")).drop("__max")


def choose(df: DataFrame, keys: Sequence[str], order: Sequence[Column], *columns: str) -> DataFrame:
    """For each key the row that is greatest by ``order``."""
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("__v"))
    return best.select(*keys, "__v.*")


def merkle(df: DataFrame, line: Column, digits: int = 3) -> DataFrame:
    """A fingerprint of a set of lines: sorted lines are hashed in buckets by the hash of the line, then the buckets' hashes.

    No task holds more than a bucket; ``digits`` sets their number (16 to that power).
    """
    lines = df.select(line.alias("line")).where("line IS NOT NULL").select("line", F.substring(F.md5("line"), 1, digits).alias("bucket"))
    buckets = lines.groupBy("bucket").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("line")), "\n"), 256).alias("h"), F.count(F.lit(1)).alias("n"))
    whole = buckets.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "h"))), lambda b: b["h"]), "\n").alias("all"), F.sum("n").alias("n_lines"))
    return whole.select(F.sha2("all", 256).alias("fingerprint"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"))
