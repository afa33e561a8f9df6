"""References to records that do not exist.

A reference is a tuple of columns that names a key in another table.  With composite keys some of
the columns may be null, and what that means is declared, as in SQL, by the match semantics:

``simple``
    a reference with any null refers to nothing and is never an orphan;
``full``
    all columns or none are null; a mixed one is an orphan of the reason ``partial_null``;
``partial``
    the columns that are not null must agree with some key.

The references are grouped by their null mask and each mask is matched on its non-null columns
only, so every join stays an equi-join.  Parents are reduced to one life row for each key before
any join: when the key first appeared and whether its last version is a deletion.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.operators.skew import left_join_unique


def key_lives(parent: DataFrame, keys: Sequence[str], loaded_at: str, deleted_at: str | None = None) -> DataFrame:
    """Columns ``keys, born, dead``: a row for each key of ``parent``; rows with a null key are not keys.

    ``born`` is the earliest load.  ``dead`` tells whether the row loaded last is a deletion; of rows
    loaded at the same time a deletion counts as the later one.
    """
    deleted = F.col(deleted_at).isNotNull() if deleted_at else F.lit(False)
    known = parent.where(_all_not_null(keys))
    return known.groupBy(*keys).agg(
        F.min(loaded_at).alias("born"),
        F.max(F.struct(F.col(loaded_at).alias("at"), deleted.alias("gone"))).getField("gone").alias("dead"),
    )


def _all_not_null(columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition


def _key(columns: Sequence[str]) -> Column:
    """One comparable value for a tuple of non-null columns."""
    if len(columns) == 1:
        return F.col(columns[0])
    return F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)]))


def _reason() -> Column:
    """The first reason that applies; null where the reference holds."""
    return (
        F.when(F.col("__born_known").isNull(), F.lit("missing"))
        .when(F.col("__dead"), F.lit("deleted"))
        .when(F.col("__born") > F.col("__loaded"), F.lit("late"))
    )


def orphan_references(
    child: DataFrame,
    parent: DataFrame,
    references: Sequence[str],
    keys: Sequence[str],
    loaded_at: str = "loaded_at",
    parent_loaded_at: str = "loaded_at",
    parent_deleted_at: str | None = "deleted_at",
    match: str = "simple",
) -> DataFrame:
    """The rows of ``child`` whose reference fails, with a column ``reason``.

    Reasons are ``partial_null`` (match ``full`` only), ``missing``, ``deleted`` and ``late`` (the
    key's first row was loaded after the child's row; equal times are fine, an unknown time is never
    late).  Under ``partial`` a reference holds if some key agrees on its non-null columns; it counts
    as deleted only if all those keys are, and as late by the earliest of them.  All-null references
    refer to nothing.  Copies of a child row come out as often as they stand; an empty parent makes
    every reference ``missing``.  A column ``reason`` of the child is replaced; other columns pass
    through, whatever their names, as helper columns start with two underscores.
    """
    if match not in ("simple", "partial", "full"):
        raise ValueError(f"unknown match semantics: {match}")
    references, keys = list(references), list(keys)
    own = [c for c in child.columns if c != "reason"]
    lives = key_lives(parent, keys, parent_loaded_at, parent_deleted_at)
    out: list[DataFrame] = []
    for mask in product((True, False), repeat=len(references)):  # True: the column is present
        present = [r for r, there in zip(references, mask) if there]
        if not present:
            continue
        rows = child
        for name, there in zip(references, mask):
            rows = rows.where(F.col(name).isNotNull() if there else F.col(name).isNull())
        if len(present) < len(references):
            if match == "simple":
                continue
            if match == "full":
                out.append(rows.withColumn("reason", F.lit("partial_null")).select(*own, "reason"))
                continue
        on = [k for k, there in zip(keys, mask) if there]
        side = lives
        if len(on) < len(keys):
            side = lives.groupBy(*on).agg(F.min("born").alias("born"), F.min("dead").alias("dead"))
        side = side.select(_key(on).alias("__key"), F.col("born").alias("__born"), F.col("dead").alias("__dead"), F.lit(True).alias("__born_known"))
        rows = rows.withColumn("__key", _key(present))
        joined = left_join_unique(rows.withColumn("__loaded", F.col(loaded_at)), side, "__key")
        out.append(joined.withColumn("reason", _reason()).where(F.col("reason").isNotNull()).select(*own, "reason"))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
