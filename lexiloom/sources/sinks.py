"""Writers: partitions that replace themselves, bundles that are counted again after writing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def write_partitions(df: DataFrame, path: str, by: str = "volume") -> None:
    """Replace the partitions that ``df`` has rows of; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def replace_part(existing: DataFrame, new: DataFrame, key: str, value) -> DataFrame:
    """An index with the rows of one part replaced."""
    return existing.where(~F.col(key).eqNullSafe(F.lit(value))).unionByName(new)


def manifest(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``name, n_rows, content``: the rows of each frame and a hash that does not depend on their order."""
    out = None
    for name, df in frames.items():
        one = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
        half = F.conv(F.substring(one, 1, 8), 16, 10).cast("decimal(20,0)")
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(half), F.lit(0)).alias("s")).select(F.lit(name).alias("name"), "n_rows", F.sha2(F.col("s").cast("string"), 256).alias("content"))
        out = row if out is None else out.unionByName(row)
    return out


def write_bundle(frames: Mapping[str, DataFrame], path: str) -> DataFrame:
    """Every frame as JSON Lines under ``path``, read again and counted; a difference raises.  Gives the manifest."""
    listed = {r["name"]: r for r in manifest(frames).collect()}
    for name, df in frames.items():
        df.write.mode("overwrite").json(f"{path}/{name}")
        again = df.sparkSession.read.schema(df.schema).json(f"{path}/{name}").count()
        if again != listed[name]["n_rows"]:
            raise OSError(f"{name}: {listed[name]['n_rows']} rows were written and {again} read again")
    return df.sparkSession.createDataFrame(list(listed.values()))


def guard_once(rows: int, references: int, least: int = 1000) -> None:
    """Refuse to resolve a corpus that has no references left: it was resolved before."""
    if rows > least and references == 0:
        raise RuntimeError("the corpus has no references; it seems to be resolved already")


def send_batches(df: DataFrame, send: Callable[[list[Row]], None], size: int = 500) -> None:
    """Hand rows to ``send`` in batches, from the executors."""

    def run(rows: Iterator[Row]) -> None:
        batch: list[Row] = []
        for row in rows:
            batch.append(row)
            if len(batch) == size:
                send(batch)
                batch = []
        if batch:
            send(batch)

    df.foreachPartition(run)


def sent_batches(df: DataFrame, send: Callable[[list[dict]], int], size: int = 500) -> DataFrame:
    """Columns ``rows, answer``: what ``send`` said to every batch of rows; nothing is sent before the result is asked for."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = frame.to_dict("records")
            said = [(len(part), int(send(part))) for part in (rows[i : i + size] for i in range(0, len(rows), size))]
            yield pd.DataFrame(said, columns=["rows", "answer"])

    return df.mapInPandas(run, "rows long, answer long")


def referenced_files(df: DataFrame, name: str, present: DataFrame) -> DataFrame:
    """Names that are referred to and are not in ``present(name)``."""
    return df.select(name).where(F.col(name).isNotNull()).distinct().join(present.select(F.col("name").alias(name)), name, "left_anti")


def outputs(df: DataFrame, key: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Every output of a document as rows ``key, consumer, fmt, text``; ``columns`` names consumer and format."""
    parts = [F.struct(F.lit(c).alias("consumer"), F.lit(f).alias("fmt"), F.col(name).alias("text")) for name, (c, f) in columns.items()]
    return df.select(key, F.explode(F.array(*parts)).alias("o")).select(key, "o.*")
