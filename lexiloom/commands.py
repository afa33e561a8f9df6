"""What can be done with a corpus from a shell: a folder with the tables ``source_pages`` and ``articles``, partitioned by volume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import markup
from lexiloom.functions import text as X
from lexiloom.operators.boundaries import walk_volumes
from lexiloom.sources import readers, sinks

PAGES = "page_id long, volume int, page_number int, source string, text string"
ARTICLES = "id string, volume int, title string, page_start int, page_end int, body string"


def init(spark: SparkSession, corpus: str) -> None:
    """Both tables, empty; tables that are there stay."""
    for name, schema in (("source_pages", PAGES), ("articles", ARTICLES)):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{corpus}/{name}")


def _table(spark: SparkSession, corpus: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{corpus}/{name}")


def import_pages(spark: SparkSession, corpus: str, source: str, volume: int) -> None:
    """The pages of one volume: a plain text with ``===PAGE===`` between pages, or a folder of page files."""
    if source.endswith(".txt"):
        whole = spark.read.text(source, wholetext=True).select(F.lit(volume).alias("volume"), F.col("value").alias("text"), F.lit(source).alias("source"))
        rows = readers.split_pages(whole, "text")
    else:
        rows, _ = readers.load_pages(spark, source, volume)
    rows = rows.select((F.col("volume").cast("long") * 1_000_000 + F.col("page_number")).alias("page_id"), "volume", "page_number", "source", F.col("raw_text").alias("text"))
    sinks.write_partitions(rows, f"{corpus}/source_pages")


def list_pages(spark: SparkSession, corpus: str, volume: int | None = None) -> DataFrame:
    pages = _table(spark, corpus, "source_pages", PAGES)
    pages = pages if volume is None else pages.where(F.col("volume") == volume)
    return pages.select("volume", "page_number", F.length("text").alias("chars"), "source").orderBy("volume", "page_number")


def reset_volume(spark: SparkSession, corpus: str, volume: int) -> None:
    """Drop the articles of a volume; its pages stay."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{corpus}/articles/volume={volume}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def detect_boundaries(spark: SparkSession, corpus: str, volume: int | None = None) -> None:
    """Articles out of the pages of a volume, or of all; they replace those that were there."""
    pages = _table(spark, corpus, "source_pages", PAGES)
    pages = pages if volume is None else pages.where(F.col("volume") == volume)
    walked = walk_volumes(pages)
    base = X.stable_id("volume", "page_start", "title")
    made = walked.select(F.concat_ws("-", base, F.col("article_no").cast("string")).alias("id"), "volume", "title", "page_start", "page_end", "body")
    sinks.write_partitions(made, f"{corpus}/articles")


def export_articles(spark: SparkSession, corpus: str, out: str, volume: int | None = None) -> DataFrame:
    """Articles as JSON Lines with their marker stream, read again and counted; gives the manifest."""
    rows = _table(spark, corpus, "articles", ARTICLES)
    rows = rows if volume is None else rows.where(F.col("volume") == volume)
    return sinks.write_bundle({"articles": rows.withColumn("body", markup.produce("body"))}, out)


def corpus_export(spark: SparkSession, corpus: str, out: str) -> DataFrame:
    """The whole corpus: articles, their links, and an index of titles."""
    rows = _table(spark, corpus, "articles", ARTICLES).withColumn("body", markup.produce("body"))
    links = rows.select("id", F.explode(markup.links("body")).alias("l")).select("id", "l.type", "l.target", "l.display")
    return sinks.write_bundle({"articles": rows, "links": links, "index": rows.select("id", "volume", "title", "page_start", "page_end")}, out)
