"""What the plan modules share: a registry and the tables as the queries need them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import text as X
from lexiloom.tables import table


class Registry:
    """Queries and their SQL by name."""

    def __init__(self) -> None:
        self.queries: dict = {}
        self.sql: dict = {}

    def __call__(self, name: str, sql: str | None = None):
        def keep(f):
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return keep


#: Long texts, which decide between rows of one time only where all else is equal, so that a query that does not use them need not read them.
LONG = ("body", "text", "raw_text", "wikitext")


def valid(spark: SparkSession, d: str, name: str = "articles", deleted: bool = False) -> DataFrame:
    """The valid row of every id; deleted ids only if asked for.

    The latest row counts; of rows of one id and time that differ, the one with the greatest digest of
    its short columns, and of those the one with the greatest digest of its long text, so that all
    columns are of one row whatever the order of reading.  Every column is an aggregate of its own, so
    that the optimizer drops those a query does not use: a body is neither read nor shuffled for a query
    on titles.
    """
    df = table(spark, d, name).where(F.col("id").isNotNull())
    short = [c for c in df.columns if c not in ("id", "loaded_at", *LONG)]
    order = F.struct(F.col("loaded_at").alias("at"), F.xxhash64(*short).alias("digest"))
    longer = {c: F.struct(F.col("loaded_at").alias("at"), F.xxhash64(*short).alias("digest"), F.xxhash64(c).alias("long")) for c in df.columns if c in LONG}
    rows = df.groupBy("id").agg(*[F.max_by(c, longer.get(c, order)).alias(c) for c in df.columns if c != "id"])
    return rows if deleted or "deleted_at" not in df.columns else rows.where(F.col("deleted_at").isNull())


def head_key(c: Column | str) -> Column:
    """The letters and digits of a title without what a bracket or a comma opens."""
    return X.article_norm(F.regexp_replace(c, r"\s*\(.*\)|,.*$", ""))


#: ``head_key`` in SQL.
HEAD = "regexp_replace(upper(strip_accents(regexp_replace({0}, '\\s*\\(.*\\)|,.*$', '', 'g'))), '[^A-Z0-9]+', '', 'g')"


def once(spark: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    """A table without its copied rows."""
    df = table(spark, d, name)
    return (df.select(*columns) if columns else df).distinct()


#: The same in SQL.
VA = "va AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) AS rn FROM articles WHERE id IS NOT NULL) WHERE rn = 1 AND deleted_at IS NULL)"
VC = "vc AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) AS rn FROM contributors WHERE id IS NOT NULL) WHERE rn = 1 AND deleted_at IS NULL)"
REFS = "refs AS (SELECT DISTINCT trim(regexp_replace(upper(normalized_target), '\\s+', ' ', 'g')) AS ref FROM xrefs WHERE normalized_target IS NOT NULL)"
