"""Names to candidates: rungs from tight to loose, every one an equi-join.

``refs`` has ``ref``, ``titles`` has ``title`` (both unique); a rung gives ``ref, title``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions import text as X
from lexiloom.session import cut_lineage


def _by_key(refs: DataFrame, titles: DataFrame, key) -> DataFrame:
    left = refs.select("ref", key(F.col("ref")).alias("k")).where(F.col("k") != "")
    return left.join(titles.select("title", key(F.col("title")).alias("k")), "k").select("ref", "title")


def exact(refs: DataFrame, titles: DataFrame) -> DataFrame:
    """The same set of words."""
    return _by_key(refs, titles, lambda c: X.word_key(X.word_set(c)))


def folded(refs: DataFrame, titles: DataFrame) -> DataFrame:
    """The same set of words without accents."""
    return _by_key(refs, titles, lambda c: X.word_key(X.word_set(X.fold_accents(c))))


def _words(df: DataFrame, name: str, words: Column) -> DataFrame:
    return df.select(name, words.alias("ws")).where(F.size("ws") > 0).select(name, F.size("ws").alias(f"{name}_n"), F.explode("ws").alias("w"))


def subset(refs: DataFrame, titles: DataFrame) -> DataFrame:
    """Titles that have all content words of the reference."""
    left = _words(refs, "ref", X.content_words("ref"))
    right = _words(titles, "title", X.word_set(X.fold_accents("title")))
    met = left.join(right, "w").groupBy("ref", "title", "ref_n").agg(F.count(F.lit(1)).alias("n"))
    return met.where(F.col("n") == F.col("ref_n")).select("ref", "title")


def superset(refs: DataFrame, titles: DataFrame, single_head: bool = True) -> DataFrame:
    """Titles all of whose content words the reference has; of those the longest.

    A title of one content word is only taken as the head of ``Head, Qualifier``.
    """
    left = _words(refs, "ref", X.content_words("ref"))
    right = _words(titles, "title", X.content_words("title"))
    met = left.join(right, "w").groupBy("ref", "title", "title_n").agg(F.count(F.lit(1)).alias("n"))
    inside = met.where(F.col("n") == F.col("title_n")).select("ref", "title", "title_n")
    longest = inside.withColumn("place", F.rank().over(Window.partitionBy("ref").orderBy(F.desc("title_n")))).where("place = 1")
    many = longest.where("title_n > 1").select("ref", "title")
    if not single_head:
        return many
    head = X.word_key(X.content_words(F.substring_index("ref", ",", 1)))
    one = longest.where((F.col("title_n") == 1) & F.col("ref").contains(",")).where(head == X.word_key(X.content_words("title")))
    return many.unionByName(one.select("ref", "title"))


def first_word(refs: DataFrame, titles: DataFrame) -> DataFrame:
    """Titles that have the reference's first word."""
    left = refs.select("ref", F.try_element_at(F.filter(F.split(F.upper(X.fold_accents("ref")), r"[^\p{L}\p{N}]+"), lambda w: w != ""), F.lit(1)).alias("w"))
    return left.where(F.col("w").isNotNull()).join(_words(titles, "title", X.word_set(X.fold_accents("title"))), "w").select("ref", "title")


def ladder(refs: DataFrame, titles: DataFrame) -> DataFrame:
    """Columns ``ref, title, rung``: the candidates of the tightest rung that has any."""
    refs, titles = cut_lineage(refs.select("ref")), cut_lineage(titles.select("title"))
    rungs = [("exact", exact), ("fold", folded), ("subset", subset), ("superset", superset), ("firstword", first_word)]
    tagged = None
    for place, (name, rung) in enumerate(rungs):
        rows = rung(refs, titles).select("ref", "title", F.lit(place).alias("place"), F.lit(name).alias("rung"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    best = Window.partitionBy("ref").orderBy("place")
    return tagged.withColumn("r", F.dense_rank().over(best)).where("r = 1").select("ref", "title", "rung")


# --- the cascade of spellings ------------------------------------------------------------------


def _variant(place: int, name: str, value: Column) -> Column:
    return F.struct(F.lit(place).alias("place"), F.lit(name).alias("how"), value.alias("key"))


def variants(ref: Column) -> Column:
    """Spellings to look up for a reference, as an array of ``place, how, key``; null keys are none."""
    words = F.split(ref, " ")
    last, rest = F.element_at(words, -1), F.array_join(F.slice(words, 1, F.greatest(F.lit(0), F.size(words) - 1)), " ")
    plain = (F.size(words) >= 2) & ~ref.contains(",")
    comma = F.instr(ref, ", ")
    swapped = F.concat(F.substring(ref, comma + 2, F.length(ref)), F.lit(" "), F.substring(ref, F.lit(1), comma - 1))
    out = [
        _variant(1, "plural", F.when(ref.endswith("IES"), F.regexp_replace(ref, "IES$", "Y"))),
        _variant(2, "plural", F.when(ref.endswith("ES"), F.regexp_replace(ref, "ES$", ""))),
        _variant(3, "plural", F.when(ref.endswith("S") & ~ref.endswith("SS"), F.regexp_replace(ref, "S$", ""))),
        _variant(4, "plural", F.concat(ref, F.lit("S"))),
        _variant(5, "plural", F.concat(ref, F.lit("ES"))),
        _variant(6, "plural", F.when(ref.endswith("Y"), F.regexp_replace(ref, "Y$", "IES"))),
        _variant(7, "inversion", F.when(plain, F.concat(last, F.lit(", "), rest))),
        _variant(8, "inversion", F.when(comma > 0, swapped)),
        _variant(9, "article", F.when(ref.endswith(", THE"), F.regexp_replace(ref, ", THE$", "")).otherwise(F.concat(ref, F.lit(", THE")))),
        _variant(10, "period", F.when(ref.endswith("."), F.regexp_replace(ref, r"\.+$", "")).otherwise(F.concat(ref, F.lit(".")))),
        _variant(12, "section", F.when(ref.contains(": "), F.trim(F.regexp_extract(ref, "^(.*): ", 1)))),
        _variant(13, "bracket", F.nullif(F.trim(F.regexp_extract(ref, r"^(.+?)\s*\([^)]+\)\s*$", 1)), F.lit(""))),
    ]
    return F.filter(F.array(*out), lambda v: v["key"].isNotNull() & (F.length(v["key"]) >= 3))


def spelled(refs: DataFrame, titles: DataFrame) -> DataFrame:
    """Columns ``ref, title, how``: the first spelling of each reference that is a title."""
    keys = refs.select("ref", F.explode(variants(F.col("ref"))).alias("v")).select("ref", "v.*")
    hits = keys.join(titles.select(F.col("title").alias("key"), "title"), "key")
    return hits.groupBy("ref").agg(F.min_by(F.struct("title", "how"), F.struct("place", "title")).alias("m")).select("ref", "m.title", "m.how")


def trailing_qualifier(refs: DataFrame, titles: DataFrame) -> DataFrame:
    """The longest beginning of a reference, cut at a comma, that is a title."""
    parts = F.transform(F.split("ref", ","), F.trim)
    cuts = F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), ", ")))
    keys = refs.select("ref", F.posexplode(cuts).alias("i", "title")).where(F.length("title") >= 3)
    return keys.join(titles, "title").groupBy("ref").agg(F.max_by("title", "i").alias("title"))


def prefix(refs: DataFrame, titles: DataFrame) -> DataFrame:
    """The shortest title that goes on after the whole reference with a comma, space or hyphen.

    Titles are exploded into their beginnings at word ends, so this is an equi-join; ties go to the
    alphabetically first.
    """
    at = F.sequence(F.lit(1), F.length("title"))
    ends = F.filter(at, lambda i: (i < F.length("title")) & F.substring(F.col("title"), i + 1, F.lit(1)).isin(",", " ", "-"))
    heads = titles.select("title", F.explode(ends).alias("i")).select("title", F.substring(F.col("title"), F.lit(1), F.col("i")).alias("ref")).where(F.length("ref") >= 4)
    return refs.join(heads, "ref").groupBy("ref").agg(F.min_by("title", F.struct(F.length("title"), "title")).alias("title"))


def initials(refs: DataFrame, titles: DataFrame) -> DataFrame:
    """``LAST, I. J.`` with the shortest title ``LAST, Forenames`` whose forenames begin so."""
    def firsts(c: Column) -> Column:
        return F.transform(F.filter(F.split(F.trim(F.regexp_extract(c, "^[^,]*, (.*)$", 1)), r"\s+"), lambda w: w != ""), lambda w: F.substring(w, 1, 1))

    left = refs.where(F.col("ref").contains(", ")).select("ref", F.substring_index("ref", ", ", 1).alias("last"), firsts(F.col("ref")).alias("fi"))
    left = left.where((F.size("fi") > 0) & F.forall("fi", lambda c: c.rlike("[A-Z]")))
    right = titles.where(F.col("title").contains(", ")).select("title", F.substring_index("title", ", ", 1).alias("last"), firsts(F.col("title")).alias("ti"))
    met = left.join(right, "last").where((F.size("ti") >= F.size("fi")) & (F.slice("ti", 1, F.size("fi")) == F.col("fi")))
    return met.groupBy("ref").agg(F.min_by("title", F.struct(F.length("title"), "title")).alias("title"))


def edit_one(refs: DataFrame, titles: DataFrame) -> DataFrame:
    """The shortest title one edit away, same first letter, lengths within one."""
    left = refs.where(F.length("ref") >= 4).select("ref", F.substring("ref", 1, 1).alias("c"), F.explode(F.array(*[F.length("ref") + i for i in (-1, 0, 1)])).alias("n"))
    right = titles.select("title", F.substring("title", 1, 1).alias("c"), F.length("title").alias("n"))
    near = left.join(right, ["c", "n"]).where((F.col("ref") != F.col("title")) & (F.levenshtein("ref", "title", 1) >= 0))
    return near.groupBy("ref").agg(F.min_by("title", F.struct(F.length("title"), "title")).alias("title"))


def cascade(refs: DataFrame, titles: DataFrame, aggressive: bool = False) -> DataFrame:
    """Columns ``ref, title, how``: each strategy on what the ones before it left."""
    steps = [
        ("exact", lambda r, t: r.join(t.select(F.col("title").alias("ref"), "title"), "ref")), ("spelling", spelled), ("initials", initials), ("prefix", prefix),
        ("qualifier", trailing_qualifier), ("fold", lambda r, t: _by_key(r, t, X.fold_accents)),
    ]
    if aggressive:
        steps.append(("edit", edit_one))
    out, left, titles = None, refs.select("ref"), cut_lineage(titles)
    for name, step in steps:
        hit = step(left, titles).groupBy("ref").agg(F.min("title").alias("title")).select("ref", "title", F.lit(name).alias("how"))
        hit = cut_lineage(hit)
        out = hit if out is None else out.unionByName(hit)
        left = cut_lineage(left.join(hit.select("ref"), "ref", "left_anti"))
    return out
