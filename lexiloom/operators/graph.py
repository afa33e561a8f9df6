"""Trees and graphs as edge tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.operators.ordered import last_known
from lexiloom.session import cut_lineage


def flatten(nodes: DataFrame) -> DataFrame:
    """``nodes(id, parent, name)`` with ``depth``, ``path`` (names from the root) and ``root``.

    Children are joined level by level, as often as the tree is deep; nodes that no root leads to
    (their parent is missing or they are in a circle) do not come out.  An id with several parents
    comes out for each; a circle that such ids bring within a root's reach is an error.
    """
    total = nodes.count()
    level = nodes.where(F.col("parent").isNull()).select("id", "parent", "name", F.lit(0).alias("depth"), F.col("name").alias("path"), F.col("id").alias("root"))
    step = nodes.select(F.col("id").alias("i"), F.col("parent").alias("p"), F.col("name").alias("n"))
    out, depth = level, 0
    while True:
        depth += 1
        if depth > total + 1:
            raise ValueError("the nodes are in a circle")
        level = step.join(level.select(F.col("id").alias("p"), "path", "root"), "p").select(F.col("i").alias("id"), F.col("p").alias("parent"), F.col("n").alias("name"), F.lit(depth).alias("depth"), F.concat_ws("/", "path", "n").alias("path"), "root")
        level = cut_lineage(level)
        if level.isEmpty():
            return out
        out = out.unionByName(level)


#: Levels of an outline; each is a column of the window, so their number is checked.
MOST_LEVELS = 64


def parents_by_level(df: DataFrame, keys: Sequence[str], order: str, level: str, id_: str) -> DataFrame:
    """``df`` with ``parent``: the last row before of a lesser level, as an outline implies.

    The last row of each level is carried forward over blocks of rows (see ``ordered``); of those of
    lesser levels the last in order is the parent.  A null level is below all others.
    """
    levels = sorted(r[0] for r in df.select(level).where(F.col(level).isNotNull()).distinct().limit(MOST_LEVELS + 1).collect())
    if len(levels) > MOST_LEVELS:
        raise ValueError("the outline has too many levels")
    if not levels:
        return df.withColumn("parent", F.lit(None).cast(df.schema[id_].dataType))
    here = F.struct(F.col(order).alias("at"), F.col(id_).alias("id"))
    marked = df
    for i, n in enumerate(levels):
        marked = last_known(marked, keys, [order], F.when(F.col(level) == n, here), f"__l{i}")
    lesser = F.array_compact(F.array(*[F.when(F.col(level).isNull() | (F.col(level) > n), F.col(f"__l{i}")) for i, n in enumerate(levels)]))
    return marked.withColumn("parent", F.array_max(lesser)["id"]).drop(*[f"__l{i}" for i in range(len(levels))])


def degrees(edges: DataFrame, source: str, target: str) -> DataFrame:
    """``node, n_out, n_in`` of a directed graph."""
    both = edges.select(F.col(source).alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(edges.select(F.col(target).alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return both.where(F.col("node").isNotNull()).groupBy("node").agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"))


def rollup(flat: DataFrame, members: DataFrame, on: str) -> DataFrame:
    """``root, n_members``: members of all nodes under each root."""
    return members.join(flat.select(F.col("id").alias(on), "root"), on).groupBy("root").agg(F.count(F.lit(1)).alias("n_members"))


def pack(df: DataFrame, keys: Sequence[str], order: Column, size: str, target: int) -> DataFrame:
    """``df`` with ``chunk``: which run of about ``target`` the row falls in, by the sum before it."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("chunk", F.floor(F.coalesce(F.sum(size).over(before), F.lit(0)) / target))
