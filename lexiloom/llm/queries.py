"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import bpe, headings, langid, mix, pack, people, scan, split
from lexiloom.llm.common import with_version
from lexiloom.tables import table

LIMIT, OVERLAP, CAPACITY = 6000, 200, 12_000


# --- 1: oversized bodies -----------------------------------------------------------------------


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each article whose valid body is too long, with the division that fits.

    The bodies are split where they are read, and only the result is brought together by article.
    """
    rows = with_version(table(spark, sf_dir, "articles")).select(F.col("id").alias("article_id"), "__version", "body")
    pieces = split.split_oversized(rows, "body", LIMIT, OVERLAP, with_text=False).where(F.coalesce("piece_no", F.lit(1)) == 1)
    valid = pieces.where(F.col("article_id").isNotNull()).groupBy("article_id").agg(F.max_by(F.struct("piece_division"), "__version").alias("v"))
    return valid.select("article_id", F.col("v.piece_division").alias("boundary")).where(F.col("boundary").isNotNull())


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the valid bodies that are too long."""
    rows = with_version(table(spark, sf_dir, "articles")).where(F.col("id").isNotNull())
    valid = rows.groupBy(F.col("id").alias("article_id")).agg(F.max("__version").alias("v"))
    long = rows.where(F.length("body") > LIMIT).select(F.col("id").alias("article_id"), "__version", "title", "body")
    chosen = long.join(valid, "article_id").where(F.col("__version") == F.col("v")).drop("v", "__version").dropDuplicates(["article_id"])
    return split.split_oversized(chosen, "body", LIMIT, OVERLAP)


# --- 3: names ----------------------------------------------------------------------------------


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contributors and entries of the printed index as records of names."""
    rows = with_version(table(spark, sf_dir, "contributors")).where(F.col("id").isNotNull())
    valid = rows.groupBy("id").agg(F.max_by(F.struct("full_name", "credentials", "description"), "__version").alias("v"))
    signs = table(spark, sf_dir, "contributor_initials").select(F.col("contributor_id").alias("id"), F.regexp_replace(F.upper("initials"), "[^\\p{L}]", "").alias("sign"))
    signs = signs.groupBy("id").agg(F.max_by("sign", F.struct(F.length("sign"), "sign")).alias("sign"))
    field = F.regexp_extract(F.lower("v.description"), r"([\p{L}-]+)\W*$", 1)
    contributors = valid.join(signs, "id", "left").select(
        F.col("id").alias("rid"), F.col("v.full_name").alias("name"), F.col("v.credentials").alias("letters"), field.alias("field"), F.col("sign").alias("signature")
    )
    entries = table(spark, sf_dir, "vol29_entries").where(F.col("id").isNotNull())
    entries = entries.groupBy("id").agg(F.max(F.struct("display", "full_name", "credentials", "initials")).alias("v")).select(
        F.col("id").alias("rid"), F.coalesce("v.display", "v.full_name").alias("name"), F.col("v.credentials").alias("letters"), F.lit(None).cast("string").alias("field"), F.col("v.initials").alias("signature")
    )
    return contributors.unionByName(entries)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of records of one person."""
    return people.pairs_of(people.link_names(_people(spark, sf_dir)))


def p3_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with the person it belongs to and the number of that person's records."""
    linked = people.link_names(_people(spark, sf_dir))
    sizes = linked.groupBy("entity").agg(F.count(F.lit(1)).alias("n_records"))
    return linked.join(sizes, "entity").select("rid", "entity", "n_records")


# --- 4: headings -------------------------------------------------------------------------------


def _spread(rows: DataFrame) -> DataFrame:
    """The rows without copies, spread by id: what follows costs computing, not reading, so few bytes must not mean few tasks."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "xref_id").distinct()


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spread(table(spark, sf_dir, "xrefs").select(F.col("id").alias("xref_id"), "surface_text", "normalized_target"))
    return headings.map_to_list(rows, "normalized_target", "surface_text", table(spark, sf_dir, "headings"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heading that each freely written reference means, 0 for none."""
    rows = table(spark, sf_dir, "xrefs").select(F.col("id").alias("xref_id"), "surface_text", "normalized_target")
    rows = rows.where(F.col("surface_text").isNotNull() | F.col("normalized_target").isNotNull())
    listed = table(spark, sf_dir, "headings").select(F.col("heading").alias("normalized_target")).where(F.col("normalized_target").isNotNull()).distinct()
    free = _spread(rows.join(listed, "normalized_target", "left_anti").select("xref_id", "surface_text", "normalized_target"))
    return headings.map_to_list(free, "normalized_target", "surface_text", table(spark, sf_dir, "headings")).select("xref_id", "heading_id")


def p4_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was written and means no heading, with the number of references."""
    value = F.lower(F.trim(F.coalesce("normalized_target", "surface_text")))
    return _mapped(spark, sf_dir).where(F.col("heading_id") == 0).groupBy(value.alias("written")).agg(F.count(F.lit(1)).alias("n_xrefs"))


def p4_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For everything written in either field, all headings within the distance its length allows."""
    xrefs = table(spark, sf_dir, "xrefs")
    written = xrefs.select(F.col("normalized_target").alias("written")).unionByName(xrefs.select(F.col("surface_text").alias("written")))
    return headings.candidates(written, "written", table(spark, sf_dir, "headings"))


def p4_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each heading with the references that mean it and the ways in which they spell it."""
    found = _mapped(spark, sf_dir).where(F.col("heading_id") > 0)
    counted = found.groupBy("heading_id").agg(F.count(F.lit(1)).alias("n_xrefs"), F.countDistinct("normalized_target").alias("n_spellings"))
    return table(spark, sf_dir, "headings").join(counted, "heading_id", "left").fillna(0, ["n_xrefs", "n_spellings"])


# --- 5: scanned pages --------------------------------------------------------------------------


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the pages with noise, by kind."""
    return scan.noise(scan.long_pages(table(spark, sf_dir, "source_pages")))[0]


def p5_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running text of each volume in whole paragraphs."""
    return scan.paragraphs(scan.long_pages(table(spark, sf_dir, "source_pages")))


def p5_misreadings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The misread word forms with the words they stand for."""
    return scan.noise(scan.long_pages(table(spark, sf_dir, "source_pages")))[1]


# --- 6: containers -----------------------------------------------------------------------------


def _containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_version(table(spark, sf_dir, "articles")).where(F.col("id").isNotNull())
    sized = rows.select(F.col("id").alias("article_id"), "__version", pack.byte_pieces(F.col("body"), CAPACITY).alias("pieces"))
    valid = sized.groupBy("article_id").agg(F.max_by(F.struct("pieces"), "__version").alias("v"))
    items = valid.select("article_id", F.size("v.pieces").alias("n_pieces"), F.explode("v.pieces").alias("p")).select("article_id", "n_pieces", "p.*")
    return pack.pack(items, ["article_id", "piece_no"], "piece_bytes", CAPACITY)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each article that had to be cut."""
    return _containers(spark, sf_dir).where((F.col("n_pieces") > 1) & (F.col("piece_no") == 1)).select("article_id")


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every valid body, or piece of one, with its container."""
    return _containers(spark, sf_dir).select("container_id", "container_fill", "article_id", "piece_no", "n_pieces", "piece_start", "piece_end", "piece_bytes")


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, the fewest that their bytes could fill, and the share of the space that is used."""
    bins = _containers(spark, sf_dir).groupBy("container_id").agg(F.sum("piece_bytes").alias("used"), F.count(F.lit(1)).alias("n"))
    return bins.agg(
        F.count(F.lit(1)).alias("n_containers"),
        F.sum("n").alias("n_items"),
        F.ceil(F.sum("used") / CAPACITY).alias("least_containers"),
        F.round(F.sum("used") / (F.count(F.lit(1)) * CAPACITY), 4).alias("used_share"),
    )


# --- 7: token ids ------------------------------------------------------------------------------


@cache
def automaton(name: str = "byte_bpe_50k", folder: str = bpe.TOKENIZERS) -> bpe.Automaton:
    return bpe.Automaton(bpe.read_ranks(name, folder))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encode_column(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", automaton())


def p7_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters, tokens of the two byte-level vocabularies, and characters a token, by source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").alias("chars"), "text")
    counted = bpe.encode_column(docs.withColumn("again", F.col("text")), "text", automaton(), "n_50k", counts_only=True)
    counted = bpe.encode_column(counted, "again", automaton("byte_bpe_multi_50k"), "n_multi", counts_only=True)
    sums = counted.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("chars").alias("n_chars"), F.sum("n_50k").alias("n_50k"), F.sum("n_multi").alias("n_multi"))
    return sums.withColumn("chars_a_token", F.round(F.col("n_chars") / F.col("n_50k"), 4))


def p7_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose ids do not spell their text again; there must be none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("before"), "text")
    again = bpe.decode_column(bpe.encode_column(docs, "text", automaton()), "ids", automaton(), "after")
    return again.where(F.coalesce("before", F.lit("")) != F.col("after")).select("doc_id", "before", "after")


# --- 8: mixture --------------------------------------------------------------------------------


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture in its shuffled order."""
    documents = table(spark, sf_dir, "documents")
    chosen, _ = mix.mixture(documents.select("doc_id", "source", "text"), table(spark, sf_dir, "mix_targets"), automaton(), with_text=True)
    return mix.shuffled(chosen).select("shuffle_key", "doc_id", "copy_no", "source", "n_tokens", "text")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share that each source has of the mixture's tokens."""
    chosen, shares = mix.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), automaton())
    listed = spark.createDataFrame(shares, "source string, target_share double, max_repeats int, source_tokens bigint, goal_tokens double")
    sums = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.sum(F.col("copies").cast("bigint")).alias("n_copies"), F.count(F.lit(1)).alias("n_documents"))
    rows = listed.join(sums, "source", "left").fillna(0, ["mixed_tokens", "n_copies", "n_documents"])
    total = F.sum("mixed_tokens").over(mix_window())
    return rows.withColumn("actual_share", F.when(total > 0, F.col("mixed_tokens") / total).otherwise(0.0))


def mix_window():
    """All rows of a table as short as the target table."""
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))


# --- 9: languages ------------------------------------------------------------------------------


def _identifier(documents: DataFrame) -> langid.Identifier:
    return langid.fit(langid.training_sample(documents))


def p9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of every document with its language and confidence."""
    documents = table(spark, sf_dir, "documents")
    return langid.passages(documents.select("doc_id", "text"), "text", _identifier(documents))


def p9_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the language of most of its text and the share of the text it has."""
    documents = table(spark, sf_dir, "documents")
    parts = langid.passages(documents.select("doc_id", F.col("lang").alias("label"), "text"), "text", _identifier(documents))
    size = F.coalesce(F.col("passage_end") - F.col("passage_start"), F.lit(0))
    langs = parts.groupBy("doc_id", "label", "passage_lang").agg(F.sum(size).alias("chars"), F.max("passage_confidence").alias("confidence"))
    whole = langs.groupBy("doc_id", "label").agg(
        F.max_by(F.struct(F.col("passage_lang").alias("lang"), "confidence", "chars"), F.struct(F.col("passage_lang").isNotNull(), "chars", "passage_lang")).alias("m"),
        F.sum("chars").alias("total"),
        F.count("passage_lang").alias("n_langs"),
    )
    return whole.select("doc_id", "label", F.col("m.lang").alias("lang"), F.col("m.confidence").alias("confidence"), F.when(F.col("total") > 0, F.col("m.chars") / F.col("total")).alias("share"), "n_langs")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose label is missing or wrong, or that mix languages: a row for each language of the text."""
    documents = table(spark, sf_dir, "documents")
    rows = documents.select("doc_id", langid.label_column(F.col("lang")).alias("label"), "text")
    parts = langid.passages(rows, "text", _identifier(documents)).where(F.col("passage_lang").isNotNull())
    texts = parts.groupBy("doc_id").agg(F.collect_set("passage_lang").alias("langs"), F.max("label").alias("label"))
    wrong = texts.where((F.size("langs") > 1) | F.col("label").isNull() | ~F.array_contains("langs", F.coalesce("label", F.lit(""))))
    return wrong.select("doc_id", F.explode("langs").alias("lang"))


QUERIES = {
    "p1_found": p1_found,
    "p1_pieces": p1_pieces,
    "p3_found": p3_found,
    "p3_entities": p3_entities,
    "p4_found": p4_found,
    "p4_unmatched": p4_unmatched,
    "p4_headings": p4_headings,
    "p4_candidates": p4_candidates,
    "p5_found": p5_found,
    "p5_paragraphs": p5_paragraphs,
    "p5_misreadings": p5_misreadings,
    "p6_found": p6_found,
    "p6_containers": p6_containers,
    "p6_report": p6_report,
    "p7_ids": p7_ids,
    "p7_multi": p7_multi,
    "p7_roundtrip": p7_roundtrip,
    "p8_mixture": p8_mixture,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_passages": p9_passages,
    "p9_documents": p9_documents,
}

_VALID = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) AS rn FROM articles WHERE id IS NOT NULL) WHERE rn = 1"

SQL = {
    # SQL has no regular expression with look-behind here: marks and blank lines are turned into one character, sentence ends into another
    "p1_found": f"""
WITH big AS (SELECT id, regexp_replace(replace(body, '«P»', chr(10) || chr(10)), '\\n[^\\S\\n]*(\\n[^\\S\\n]*)+', chr(1), 'g') AS t FROM ({_VALID}) WHERE length(body) > 6000),
paragraphs AS (SELECT id, unnest(string_split(t, chr(1))) AS p FROM big),
sentences AS (SELECT id, p, unnest(string_split(regexp_replace(p, '([.!?])\\s+', '\\1' || chr(2), 'g'), chr(2))) AS s FROM paragraphs),
words AS (SELECT id, p, s, unnest(regexp_split_to_array(s, '\\s+')) AS w FROM sentences)
SELECT id AS article_id, CASE WHEN max(length(trim(p, chr(10) || chr(13) || chr(9) || ' '))) <= 6000 THEN 'paragraph' WHEN max(length(s)) <= 6000 THEN 'sentence' WHEN max(length(w)) <= 6000 THEN 'word' ELSE 'none' END AS boundary
FROM words GROUP BY id""",
    "p6_found": f"SELECT id AS article_id FROM ({_VALID}) WHERE octet_length(encode(body)) > 12000",
}
