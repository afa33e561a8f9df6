"""The Structured Streaming extension: files that arrive, events that come late."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid4().hex}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there and give what it wrote; nothing passes through the driver."""
    spark = stream.sparkSession
    out, state = shared_folder(spark, "stream"), shared_folder(spark, "state")
    stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def distinct_events(events: DataFrame, key: str, at: str, delay: str = "1 hour") -> DataFrame:
    """The first arrival of every key; a repetition later than ``delay`` is not known any more."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, at: str, kind: str, value: str, width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Events, and the sum of their values, by window and kind; a window comes out when it can get no more."""
    counted = events.withWatermark(at, delay).groupBy(F.window(at, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return counted.select(F.col("w.start").alias("starts"), kind, "n", "total")


def known_keys(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame | None:
    """The keys of what has been ingested into ``target``, null if that is nothing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(target)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.parquet(target).select(*keys)


def ingest(arrivals: DataFrame, target: str, keys: Sequence[str], state: str | None = None) -> None:
    """Add arriving rows whose keys are new to the table at ``target``.

    Every batch is appended as the partition ``batch`` of its number and written over if it is run again,
    so neither a lost batch nor a restart (with the same ``state``) loses or doubles a row, and no batch
    rewrites what is there.  Of rows of one key in a batch the one with the greatest digest is taken.
    """
    spark = arrivals.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        rest = [c for c in batch.columns if c not in keys]
        new = batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.xxhash64(*rest)).alias("__v")).select(*keys, "__v.*") if rest else batch.distinct()
        old = known_keys(spark, target, [*keys, "batch"])
        if old is not None:
            new = new.join(old.where(F.col("batch") != number).select(*keys), list(keys), "left_anti")
        new.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    arrivals.writeStream.foreachBatch(merge).option("checkpointLocation", state or shared_folder(spark, "ingest")).trigger(availableNow=True).start().awaitTermination()
