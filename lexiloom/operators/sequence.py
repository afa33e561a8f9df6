"""Operators on ordered rows."""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.operators.ordered import running_sum


def slices(df: DataFrame, keys: Sequence[str], start: str, size: Column, out: str) -> DataFrame:
    """``df`` with ``out``: where the row's slice ends, at the next row's start or at ``size``."""
    following = Window.partitionBy(*keys).orderBy(start)
    return df.withColumn(out, F.coalesce(F.lead(start).over(following), size))


def plausible(df: DataFrame, keys: Sequence[str], order: str, value: str, within: int = 2) -> DataFrame:
    """``df`` with ``kept``: whether one of the two rows to either side has a value within ``within``."""
    near = Window.partitionBy(*keys).orderBy(order)
    others = [F.lag(value, i).over(near) for i in (1, 2)] + [F.lead(value, i).over(near) for i in (1, 2)]
    agree = F.lit(False)
    for other in others:
        agree = agree | F.coalesce(F.abs(F.col(value) - other) <= within, F.lit(False))
    return df.withColumn("kept", agree)


def islands(df: DataFrame, keys: Sequence[str], order: str, value: str, blocks: int | None = None) -> DataFrame:
    """``df`` with ``island``: the number, from 1, of the run of equal values it is in."""
    before = Window.partitionBy(*keys).orderBy(order)
    fresh = F.when(F.lag(value).over(before).eqNullSafe(F.col(value)) & (F.row_number().over(before) > 1), 0).otherwise(1)
    numbered = running_sum(df.withColumn("__new", fresh), keys, [order], "__new", "__before", blocks)
    return numbered.withColumn("island", F.col("__before") + F.col("__new")).drop("__before", "__new")


def fill_gaps(anchors: DataFrame, keys: Sequence[str], at: str, value: str) -> DataFrame:
    """Columns ``keys, at, value`` for every place from one anchor to the next, counting on.

    Anchors of one place that disagree are dropped.  Between anchors whose values do not rise by the
    places between them, only as many places are filled as the rise leaves; the rest is null.
    """
    agreed = anchors.groupBy(*keys, at).agg(F.min(value).alias(value), F.max(value).alias("__max")).where(F.col(value) == F.col("__max")).drop("__max")
    order = Window.partitionBy(*keys).orderBy(at)
    spans = agreed.withColumn("__to", F.coalesce(F.lead(at).over(order) - 1, F.col(at))).withColumn("__next", F.lead(value).over(order))
    spread = spans.withColumn("__at", F.explode(F.sequence(F.col(at), F.col("__to"))))
    made = F.col(value) + F.col("__at") - F.col(at)
    return spread.select(*keys, F.col("__at").alias(at), F.when(F.col("__next").isNull() | (made < F.col("__next")), made).alias(value))


def repeat_suffix(df: DataFrame, keys: Sequence[str], name: str, order: Sequence[str], out: str) -> DataFrame:
    """``df`` with ``out``: the name, with ``-2``, ``-3`` ... for its repetitions in order."""
    place = F.row_number().over(Window.partitionBy(*keys, name).orderBy(*order))
    return df.withColumn(out, F.when(place == 1, F.col(name)).otherwise(F.concat(F.col(name), F.lit("-"), place.cast("string"))))


def first_met_number(df: DataFrame, keys: Sequence[str], name: str, order: str, out: str) -> DataFrame:
    """``df`` with ``out``: the rank, by first place, of the name within its key."""
    met = df.groupBy(*keys, name).agg(F.min(order).alias("__first"))
    ranked = met.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy("__first", name))).drop("__first")
    return df.join(ranked, [*keys, name])


def unique_ids(df: DataFrame, base: str, other: str, order: Sequence[str], out: str) -> DataFrame:
    """``df`` with ``out``: unique ids from two hashes.

    The first row of a base keeps it.  The others take their second hash if no base has it and they
    are the first to claim it, else the base with a number; numbers count these rows only.
    """
    place = F.row_number().over(Window.partitionBy(base).orderBy(*order))
    ranked = df.withColumn("__place", place)
    free = ranked.where("__place > 1").join(df.select(F.col(base).alias(other)).distinct(), other, "left_anti")
    claim = F.row_number().over(Window.partitionBy(other).orderBy(*order))
    claimed = free.withColumn("__claim", claim).where("__claim = 1").drop("__claim").withColumn(out, F.col(other))
    kept = ranked.where("__place = 1").withColumn(out, F.col(base))
    rest = ranked.where("__place > 1").join(claimed.select(*order), list(order), "left_anti")
    number = F.row_number().over(Window.partitionBy(base).orderBy(*order)) + 1
    rest = rest.withColumn(out, F.concat(F.col(base), F.lit("-"), number.cast("string")))
    return kept.select(*df.columns, out).unionByName(claimed.select(*df.columns, out)).unionByName(rest.select(*df.columns, out))


def reachable(values: Sequence[float | None]) -> list[bool]:
    """For each value whether at least half of the later ones are not below it; a null is not."""
    later: list[float] = []
    out = []
    for v in reversed(values):
        out.append(v is not None and 2 * (len(later) - bisect_left(later, v)) >= len(later))
        insort(later, float("-inf") if v is None else v)
    return out[::-1]


def rising(df: DataFrame, key: str, order: str, value: str, schema: str) -> DataFrame:
    """``df`` with ``kept``: whether the value is greater than the last kept one and not beyond what can follow.

    A rejected row does not move the bar, so this is a scan of each key (one task a key, as long as a
    volume); a value is beyond reach if fewer later rows are at or above it than are below.
    """

    def scan(frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame.sort_values(order, kind="stable")
        values = [None if pd.isna(v) else v for v in rows[value]]
        kept, last = [], float("-inf")
        for v, fine in zip(values, reachable(values)):
            fine = fine and v > last
            kept.append(bool(fine))
            last = v if fine else last
        return rows.assign(kept=kept)

    return df.groupBy(key).applyInPandas(scan, schema)


def greedy_bins(df: DataFrame, key: str, order: str, size: str, target: int, schema: str) -> DataFrame:
    """``df`` with ``bin``: rows in order fill bins up to ``target``; a row beyond it opens the next bin."""

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame.sort_values(order, kind="stable")
        bins, at, used = [], 0, 0
        for n in rows[size]:
            if used and used + n > target:
                at, used = at + 1, 0
            used += n
            bins.append(at)
        return rows.assign(bin=bins)

    return df.groupBy(key).applyInPandas(fill, schema)


def advance(names: list[str], openers: list[list[str]]) -> list[int]:
    """The category that each line is in, where a line can only open the next one.

    A line that also opens the current category is a repetition of it.
    """
    out, current = [], -1
    for name in names:
        following = current + 1
        if following < len(openers) and name in openers[following] and not (current >= 0 and name in openers[current]):
            current = following
        out.append(current)
    return out


def known_order(df: DataFrame, key: str, order: str, name: str, openers: list[list[str]], schema: str) -> DataFrame:
    """``df`` with ``category``: the number of the category whose opener was met last, in known order."""

    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame.sort_values(order, kind="stable")
        return rows.assign(category=advance(rows[name].tolist(), openers))

    return df.groupBy(key).applyInPandas(walk, schema)


def locate(text: str, signs: Sequence[str], expected: Sequence[int]) -> list[int | None]:
    """Places of signs in a text that never go back: as many as can be placed, as near as can be to where they are expected.

    The candidates are all occurrences of all signs.  A chain of them is best that has the most, and of
    those the one with the least sum of distances; the best chain that ends at or before a place is
    looked up in a tree of minima over places, so the search is exact and takes the number of
    occurrences times its logarithm.  A sign that the chain leaves out is null.
    """
    found = [[m.start() for m in re.finditer(f"(?={re.escape(s)})", text)] if s else [] for s in signs]
    places = sorted({p for ps in found for p in ps})
    rank = {p: i + 1 for i, p in enumerate(places)}
    none = (0, 0, -1)
    tree = [none] * (len(places) + 1)  # of chains: minus their length, their distances, their last link
    links: list[tuple[int, int, int]] = []  # sign, place, link before
    for sign, (ps, wanted) in enumerate(zip(found, expected)):
        new = []
        for p in ps:
            best, i = none, rank[p]
            while i:
                best = min(best, tree[i], key=lambda c: c[:2])
                i &= i - 1
            new.append((p, (best[0] - 1, best[1] + abs(p - wanted), len(links))))
            links.append((sign, p, best[2]))
        for p, chain in new:  # a sign is placed once: its own places are no beginning for each other
            i = rank[p]
            while i < len(tree):
                if chain[:2] < tree[i][:2]:
                    tree[i] = chain
                i += i & -i
    best, i = none, len(places)
    while i:
        best = min(best, tree[i], key=lambda c: c[:2])
        i &= i - 1
    out: list[int | None] = [None] * len(signs)
    at = best[2]
    while at >= 0:
        sign, out[sign], at = links[at][0], links[at][1], links[at][2]
    return out


def clamp(found: list[int | None], expected: list[int], size: int) -> list[int]:
    """Places for what was not found: the expected ones, kept between the found ones around them."""
    out, floor = [], 0
    for i, place in enumerate(found):
        ceiling = next((p for p in found[i:] if p is not None), size)
        out.append(place if place is not None else min(max(expected[i], floor), ceiling))
        floor = out[-1]
    return out


def spread_cells(rows: list[list[tuple[str, int, int]]]) -> list[list[str]]:
    """A table's cells ``(text, rowspan, colspan)`` as a full grid: spans are repeated across and carried down."""
    grid: list[list[str]] = []
    carried: dict[int, tuple[str, int]] = {}
    for row in rows:
        line: list[str] = []
        cells = iter(row)
        cell = next(cells, None)
        while cell is not None or len(line) in carried:
            at = len(line)
            if at in carried:
                text, left = carried.pop(at)
                line.append(text)
                if left > 1:
                    carried[at] = (text, left - 1)
                continue
            text, down, across = cell
            for i in range(max(1, across)):
                line.append(text if i == 0 else "")
                if down > 1:
                    carried[at + i] = (text if i == 0 else "", down - 1)
            cell = next(cells, None)
        grid.append(line)
    return grid

