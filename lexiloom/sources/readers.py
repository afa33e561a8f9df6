"""Readers that lose nothing: each gives the rows it could read and the failures, with reasons.

In strict mode failures raise, and all of them are told, not the first.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE = T.StructType(
    [
        T.StructField("volume", T.IntegerType()), T.StructField("page_number", T.IntegerType()), T.StructField("source", T.StringType()),
        T.StructField("title", T.StringType()), T.StructField("raw_text", T.StringType()), T.StructField("_corrupt", T.StringType()),
    ]
)


class PartialLoad(Exception):
    """Some members could not be read; ``failures`` has every one with its reason."""

    def __init__(self, failures: list[tuple[str, str]]):
        self.failures = failures
        super().__init__(f"{len(failures)} members could not be read: " + "; ".join(f"{m}: {r}" for m, r in failures[:50]) + (" ..." if len(failures) > 50 else ""))


def settle(rows: DataFrame, failures: DataFrame, strict: bool, most: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """Raise in strict mode if there are failures (the first ``most`` of them are named), else hand both on."""
    if strict:
        named = failures.select("member", "reason").orderBy("member", "reason").limit(most).collect()
        if named:
            raise PartialLoad([(r["member"], r["reason"]) for r in named])
    return rows, failures


def split_valid(df: DataFrame, member: Column, checks: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all checks, and ``member, reason`` of the others with the first check that failed."""
    reason = None
    for name, passes in checks:
        failed = ~F.coalesce(passes, F.lit(False))
        reason = F.when(failed, name) if reason is None else reason.when(failed, name)
    judged = df.withColumn("__reason", reason)
    return judged.where(F.col("__reason").isNull()).drop("__reason"), judged.where(F.col("__reason").isNotNull()).select(member.alias("member"), F.col("__reason").alias("reason"))


def load_pages(spark: SparkSession, folder: str, volume: int | None = None, pages: Iterable[int] | None = None, strict: bool = True, corrections: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Page files ``vol_NN/volNN-pagePPPP.json`` under a folder.

    A volume is read from its own folder only; pages are selected by file name before they are parsed.
    A file that cannot be parsed, lacks its text or disagrees with its name fails, and so does a page
    that was asked for and is not there.
    """
    path = f"{folder}/vol_{volume:02d}" if volume is not None else folder
    wanted = sorted(set(pages)) if pages is not None else None
    glob = "*.json" if wanted is None or volume is None else "{" + ",".join(f"vol{volume:02d}-page{p:04d}.json" for p in wanted) + "}"
    reader = spark.read.schema(PAGE).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    df = reader.json(path).withColumn("member", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))
    df = df.withColumn("named_volume", F.expr("try_cast(regexp_extract(member, '^vol([0-9]+)-page', 1) as int)")).withColumn("named_page", F.expr("try_cast(regexp_extract(member, '-page([0-9]+)[.]json$', 1) as int)"))
    checks = [
        ("unreadable", F.col("_corrupt").isNull()), ("bad file name", F.col("named_volume").isNotNull() & F.col("named_page").isNotNull()), ("missing field", F.col("raw_text").isNotNull() & F.col("volume").isNotNull() & F.col("page_number").isNotNull()),
        ("name and content disagree", (F.col("volume") == F.col("named_volume")) & (F.col("page_number") == F.col("named_page"))),
    ]
    good, failures = split_valid(df, F.col("member"), checks)
    good = good.select("volume", "page_number", "source", "title", "raw_text")
    if wanted is not None and volume is not None:
        asked = spark.createDataFrame([(volume, p) for p in wanted], "volume int, page_number int")
        read = df.select(F.col("named_volume").alias("volume"), F.col("named_page").alias("page_number"))
        absent = asked.join(read, ["volume", "page_number"], "left_anti").select(F.format_string("vol%02d-page%04d.json", "volume", "page_number").alias("member"), F.lit("absent").alias("reason"))
        failures = failures.unionByName(absent)
    if corrections is not None:
        good = correct(good, corrections)
    return settle(good, failures, strict)


def correct(pages: DataFrame, corrections: DataFrame, text: str = "raw_text") -> DataFrame:
    """Literal corrections ``volume, place, wrong, right`` applied in order of place to the texts of their volume."""
    lists = corrections.groupBy("volume").agg(F.array_sort(F.collect_list(F.struct("place", "wrong", "right"))).alias("__fixes"))
    fixed = F.aggregate("__fixes", F.col(text), lambda t, c: F.replace(t, c["wrong"], c["right"]))
    return pages.join(lists, "volume", "left").withColumn(text, F.coalesce(fixed, F.col(text))).drop("__fixes")


SIDECARS = ("index.json", "contributors.json")


def load_corpus(spark: SparkSession, folder: str, schema: T.StructType, require: Sequence[str] = ("id", "body"), strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Exported documents, one JSON object a file; sidecar files are left out, required fields must be there."""
    names = [f for f in schema.fields if f.name != "_corrupt"]
    full = T.StructType([*names, T.StructField("_corrupt", T.StringType())])
    df = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("pathGlobFilter", "*.json").json(folder)
    df = df.withColumn("member", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)).where(~F.col("member").isin(*SIDECARS))
    checks = [("unreadable", F.col("_corrupt").isNull())] + [(f"missing {name}", F.col(name).isNotNull()) for name in require]
    good, failures = split_valid(df, F.col("member"), checks)
    return settle(good.drop("_corrupt", "member"), failures, strict)


def volume_text(pages: DataFrame, text: str = "raw_text", sep: str = "\n") -> DataFrame:
    """Columns ``volume, text``: the pages of each volume in order, as one string (a volume is a bounded book)."""
    pieces = F.array_sort(F.collect_list(F.struct("page_number", F.coalesce(text, F.lit("")).alias("t"))))
    return pages.groupBy("volume").agg(F.array_join(F.transform(pieces, lambda p: p["t"]), sep).alias("text"))


def split_pages(df: DataFrame, text: str, sign: str = "===PAGE===") -> DataFrame:
    """Plain texts cut at a sign into pages numbered from 1, without outer white space; empty ones keep their number."""
    return df.select(*[c for c in df.columns if c != text], F.posexplode(F.split(text, sign)).alias("pos", "t")).withColumn("page_number", F.col("pos") + 1).withColumn("raw_text", F.trim(F.regexp_replace("t", r"^\s+|\s+$", ""))).drop("pos", "t")


def titles_dump(spark: SparkSession, path: str, namespaces: Sequence[int] = (0, 100)) -> DataFrame:
    """Titles of the wanted namespaces in a (gzipped) tab-separated dump ``namespace, title``; no file gives no titles."""
    try:
        df = spark.read.option("sep", "\t").schema("namespace int, title string").csv(path)
    except Exception as error:  # an absent dump means that nothing is known to exist
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "title string")
    return df.where(F.col("namespace").isin(*namespaces)).select(F.translate("title", "_", " ").alias("title")).distinct()


def recognised_pages(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of page number to recognised text, as rows ``page, line_no, line``."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    pages = whole.select(F.explode("m").alias("page", "text"))
    return pages.select(F.col("page").cast("int").alias("page"), F.posexplode(F.split("text", "\n")).alias("pos", "line")).select("page", (F.col("pos") + 1).alias("line_no"), "line")


def confident_pages(spark: SparkSession, path: str) -> DataFrame:
    """Leaves whose printed number was read with a stated confidence: ``leaf, page``."""
    schema = "pages array<struct<leafNum:int,pageNumber:string,confidence:double>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("pages").alias("p")).select("p.*")
    return rows.where(F.col("confidence").isNotNull() & F.col("pageNumber").rlike(r"^\d+$")).select(F.col("leafNum").alias("leaf"), F.col("pageNumber").cast("int").alias("page"))


def containing(df: DataFrame, text: str, parts: Sequence[str]) -> DataFrame:
    """Rows whose text has any of the parts, whatever its case; a plain filter that stays before any UDF."""
    condition = F.lit(False)
    for part in parts:
        condition = condition | F.lower(text).contains(part.lower())
    return df.where(condition)


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], overwrite: bool) -> DataFrame:
    """``existing`` with the new rows of ``incoming``; where a key is in both, the old row stays or, with ``overwrite``, the new one."""
    if overwrite:
        return existing.join(incoming.select(*keys), list(keys), "left_anti").unionByName(incoming)
    return existing.unionByName(incoming.join(existing.select(*keys), list(keys), "left_anti"))
