"""Problem 6: filling containers of fixed capacity by hierarchical residual packing.

Every partition packs its items by best fit, the largest first.  Bins that are nearly full are
final; the others become items themselves (a bin is an item of its fill) and are brought together in
fewer partitions, where best fit is repeated, and so on up a tree.  What moves are sizes and ids,
never the texts.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.session import cut_lineage

PIECE = T.StructType(
    [
        T.StructField("piece_no", T.IntegerType()),
        T.StructField("piece_start", T.IntegerType()),
        T.StructField("piece_end", T.IntegerType()),
        T.StructField("piece_bytes", T.IntegerType()),
    ]
)


def cut_bytes(text: str, capacity: int) -> list[tuple[int, int, int, int]]:
    """Pieces ``(number, start, end, bytes)`` of a text over the capacity, as full as whole characters allow.

    ``start`` and ``end`` count code points.
    """
    data, out, at, point = text.encode("utf-8"), [], 0, 0
    while at < len(data):
        end = min(at + capacity, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        points = len(data[at:end].decode("utf-8"))
        out.append((len(out) + 1, point, point + points, end - at))
        at, point = end, point + points
    return out


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: largest item first, each into the fullest bin that still takes it."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (space left, bin), sorted
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, home = room.pop(at)
        else:
            left, home = capacity, len(bins)
            bins.append([])
        bins[home].append(item)
        if left - size > 0:
            insort(room, (left - size, home))
    return bins


def byte_pieces(text: Column, capacity: int) -> Column:
    """The pieces of a text: one, unless it alone exceeds the capacity; null for a null text."""

    @F.pandas_udf(T.ArrayType(PIECE))
    def cut(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = PIECE.fieldNames()
        for series in texts:
            yield pd.Series([None if t is None else [dict(zip(names, p)) for p in cut_bytes(t, capacity)] for t in series], dtype=object)

    size = F.octet_length(text)
    whole = F.array(F.struct(F.lit(1).alias("piece_no"), F.lit(0).alias("piece_start"), F.length(text).alias("piece_end"), size.alias("piece_bytes")))
    return F.when(size > capacity, cut(F.when(size > capacity, text))).when(text.isNotNull(), whole)


def pack(items: DataFrame, item_id: list[str], size: str, capacity: int, nearly_full: float = 0.98, per_task: int = 20_000, least_saving: float = 0.001) -> DataFrame:
    """``items`` with ``container_id`` and ``container_fill``.

    The columns ``item_id`` together must be unique and not null; a container is named by the least of
    its items' ids, written with ``/`` between the columns.  Rows of a null size are left out.  A size of
    0 counts as 1, so that a container holds at most ``capacity`` items, and one above the capacity is
    an error.  ``items`` is written down once, so what it is made from is read once.

    A task gets about ``per_task`` bins in every round, whatever the size of the input, and bins meet
    others in every round.  The rounds end when one task has packed all that was left, or when a round
    has saved less than ``least_saving`` of its bins: then what is left does not fit together.
    """
    bins_schema = "bin string, fill int, members array<string>"
    key = F.concat_ws("/", *[F.col(c).cast("string") for c in item_id])
    items = cut_lineage(items.where(F.col(size).isNotNull()).withColumn("__item", key))
    work = items.select(F.col("__item").alias("bin"), F.greatest(F.lit(1), F.col(size).cast("int")).alias("fill"))
    work = work.withColumn("fill", F.when(F.col("fill") <= capacity, F.col("fill")).otherwise(F.raise_error(F.lit("an item exceeds the capacity")).cast("int")))
    bins = work.withColumn("members", F.array("bin"))

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [f for f in frames if len(f)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True).sort_values("bin", kind="stable", ignore_index=True)
        fills, members, ids = rows["fill"].tolist(), rows["members"].tolist(), rows["bin"].tolist()
        out = []
        for chosen in best_fit(fills, capacity):
            inside = [m for i in chosen for m in members[i]]
            out.append((min(ids[i] for i in chosen), sum(fills[i] for i in chosen), inside))
        yield pd.DataFrame(out, columns=["bin", "fill", "members"])

    final: list[DataFrame] = []
    count, turn = bins.count(), 0
    while True:
        tasks = max(1, math.ceil(count / per_task))
        packed = cut_lineage(bins.repartition(tasks, F.xxhash64(F.lit(turn), "bin")).mapInPandas(merge, bins_schema))
        full = F.col("fill") >= F.lit(int(capacity * nearly_full))
        final.append(packed.where(full))
        bins = packed.where(~full)
        before, turn = count, turn + 1
        count, made = packed.agg(F.count(F.when(~full, 1)), F.count(F.lit(1))).first()
        if tasks == 1 or count == 0 or made > (1 - least_saving) * before:
            break
    final.append(bins)
    done = final[0]
    for more in final[1:]:
        done = done.unionByName(more)
    homes = done.select(F.col("bin").alias("container_id"), F.col("fill").alias("container_fill"), F.explode("members").alias("__item"))
    return items.join(homes, "__item").drop("__item")
