"""Sources, sinks, predicates and text structure over the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiloom.functions import markup
from lexiloom.functions import text as X
from lexiloom.functions.leaks import find_leaks
from lexiloom.operators.boundaries import walk_volumes
from lexiloom.operators.intervals import range_join
from lexiloom.plans.common import VA, Registry, once, valid
from lexiloom.sources import readers, sinks
from lexiloom.tables import table

query = Registry()
QUERIES, SQL = query.queries, query.sql


@query("sc2_volume_text", "SELECT volume, sha256(string_agg(coalesce(raw_text, ''), chr(10) ORDER BY page_number, coalesce(raw_text, ''))) AS digest FROM (SELECT DISTINCT volume, page_number, raw_text FROM source_pages) GROUP BY volume")
def sc2(spark, d):
    return readers.volume_text(once(spark, d, "source_pages", "volume", "page_number", "raw_text")).select("volume", F.sha2("text", 256).alias("digest"))


@query("sc3_require_split", "SELECT CASE WHEN text IS NULL THEN 'missing text' WHEN lang IS NULL THEN 'missing lang' WHEN source IS NULL THEN 'missing source' ELSE 'good' END AS reason, count(*) AS n FROM documents GROUP BY 1")
def sc3(spark, d):
    docs = table(spark, d, "documents")
    good, bad = readers.split_valid(docs, F.col("doc_id"), [(f"missing {c}", F.col(c).isNotNull()) for c in ("text", "lang", "source")])
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).unionByName(good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("reason"), "n"))


@query("sc5_corrections", "SELECT DISTINCT id, replace(replace(raw_text, 'tlie', 'the'), 'vvas', 'was') AS fixed FROM source_pages WHERE volume <= 14 UNION SELECT DISTINCT id, raw_text FROM source_pages WHERE volume > 14")
def sc5(spark, d):
    fixes = spark.createDataFrame([(v, i, w, r) for v in range(1, 15) for i, (w, r) in enumerate((("tlie", "the"), ("vvas", "was")))], "volume int, place int, wrong string, right string")
    return readers.correct(table(spark, d, "source_pages"), fixes).select("id", F.col("raw_text").alias("fixed")).distinct()


_HALVES = "a AS (SELECT doc_id, source FROM documents WHERE doc_id % 3 < 2), b AS (SELECT doc_id, upper(source) AS source FROM documents WHERE doc_id % 3 > 0)"


def _halves(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return docs.where("doc_id % 3 < 2"), docs.where("doc_id % 3 > 0").withColumn("source", F.upper("source"))


@query("sc8_upsert_skip", f"WITH {_HALVES} SELECT * FROM a UNION ALL SELECT * FROM b WHERE doc_id NOT IN (SELECT doc_id FROM a)")
def sc8_skip(spark, d):
    return readers.upsert(*_halves(spark, d), ["doc_id"], overwrite=False)


@query("sc8_upsert_overwrite", f"WITH {_HALVES} SELECT * FROM b UNION ALL SELECT * FROM a WHERE doc_id NOT IN (SELECT doc_id FROM b)")
def sc8_overwrite(spark, d):
    return readers.upsert(*_halves(spark, d), ["doc_id"], overwrite=True)


@query("sc9_split_pages", "SELECT id, page_number, regexp_replace(t, '^\\s+|\\s+$', '', 'g') AS raw_text FROM (SELECT id, unnest(range(1, len(p) + 1)) AS page_number, unnest(p) AS t FROM (SELECT DISTINCT id, string_split(raw_text, '. ') AS p FROM source_pages))")
def sc9(spark, d):
    return readers.split_pages(once(spark, d, "source_pages", "id", "raw_text"), "raw_text", r"\. ").select("id", F.col("page_number").cast("bigint").alias("page_number"), "raw_text")


@query("sc10_index_entries", "SELECT DISTINCT id, trim(split_part(display, ',', 1)) AS surname, CASE WHEN contains(display, ',') THEN trim(substr(display, strpos(display, ',') + 1)) END AS rest, len(articles) AS n_articles FROM vol29_entries")
def sc10(spark, d):
    rest = F.when(F.col("display").contains(","), F.trim(F.expr("substring(display, instr(display, ',') + 1)")))
    return table(spark, d, "vol29_entries").select("id", F.trim(F.substring_index("display", ",", 1)).alias("surname"), rest.alias("rest"), F.size("articles").cast("bigint").alias("n_articles")).distinct()


@query("sc12_substring_scan", "SELECT doc_id FROM documents WHERE contains(lower(text), 'abbey') OR contains(lower(text), 'harbour')")
def sc12(spark, d):
    return readers.containing(table(spark, d, "documents").select("doc_id", "text"), "text", ["abbey", "harbour"]).select("doc_id")


@query("sc13_template_entries", "SELECT DISTINCT id, trim(split_part(t, '|', 1)) AS name, len(string_split(t, '|')) - 1 AS n_args FROM (SELECT id, unnest(regexp_extract_all(wikitext, '\\{\\{([^{}]*)\\}\\}', 1)) AS t FROM source_pages)")
def sc13(spark, d):
    t = table(spark, d, "source_pages").select("id", F.explode(F.regexp_extract_all("wikitext", F.lit(r"\{\{([^{}]*)\}\}"), F.lit(1))).alias("t"))
    return t.select("id", F.trim(F.substring_index("t", "|", 1)).alias("name"), (F.size(F.split("t", r"\|")) - 1).cast("bigint").alias("n_args")).distinct()


@query("sc14_table_scan", "SELECT volume, count(DISTINCT page_number) AS n_pages, min(page_number) AS first_page FROM source_pages GROUP BY volume")
def sc14(spark, d):
    pages = table(spark, d, "source_pages").select("volume", "page_number").distinct()
    return pages.groupBy("volume").agg(F.count(F.lit(1)).alias("n_pages"), F.min("page_number").alias("first_page"))


@query("sk2_index_merge", f"WITH {VA} SELECT id, volume, title, 'old' AS build FROM va WHERE volume <> 3 UNION ALL SELECT id, volume, upper(title), 'new' FROM va WHERE volume = 3")
def sk2(spark, d):
    rows = valid(spark, d).select("id", "volume", "title", F.lit("old").alias("build"))
    new = rows.where("volume = 3").withColumn("title", F.upper("title")).withColumn("build", F.lit("new"))
    return sinks.replace_part(rows, new, "volume", 3)


@query("sk4_manifest", f"WITH {VA} SELECT 'articles' AS name, count(*) AS n_rows FROM va UNION ALL SELECT 'xref_edges', count(*) FROM (SELECT DISTINCT id, article_id, target_article_id FROM xrefs WHERE status = 'resolved') UNION ALL SELECT 'topics', count(*) FROM headings UNION ALL SELECT 'contributors', count(*) FROM (SELECT DISTINCT id FROM contributors)")
def sk4(spark, d):
    frames = {
        "articles": valid(spark, d), "xref_edges": once(spark, d, "xrefs", "id", "article_id", "target_article_id", "status").where("status = 'resolved'").drop("status"),
        "topics": table(spark, d, "headings"), "contributors": once(spark, d, "contributors", "id"),
    }
    return sinks.manifest(frames).select("name", "n_rows")


@query("sk5_referenced_files", f"WITH {VA}, r AS (SELECT DISTINCT section_name AS name FROM va WHERE section_name IS NOT NULL) SELECT name FROM r WHERE name NOT IN (SELECT target_section FROM xrefs WHERE target_section IS NOT NULL)")
def sk5(spark, d):
    present = table(spark, d, "xrefs").where("target_section IS NOT NULL").select(F.col("target_section").alias("name")).distinct()
    return sinks.referenced_files(valid(spark, d).withColumnRenamed("section_name", "name"), "name", present)


@query("sk6_resolution_snapshot", "SELECT DISTINCT id, normalized_target, status, CASE WHEN status = 'resolved' THEN target_article_id END AS target FROM xrefs")
def sk6(spark, d):
    return table(spark, d, "xrefs").select("id", "normalized_target", "status", F.when(F.col("status") == "resolved", F.col("target_article_id")).alias("target")).distinct()


@query("sk7_index_snapshot", f"WITH {VA} SELECT volume, page_start, title, concat_ws(chr(9), volume, page_start, page_end, coalesce(article_type, ''), title) AS line FROM va")
def sk7(spark, d):
    line = F.concat_ws("\t", F.col("volume").cast("string"), F.col("page_start").cast("string"), F.col("page_end").cast("string"), F.coalesce("article_type", F.lit("")), F.col("title"))
    return valid(spark, d).select("volume", "page_start", "title", line.alias("line")).orderBy("volume", "page_start", "title")


@query("sk13_outputs", f"WITH {VA} SELECT id, 'site' AS consumer, 'title' AS fmt, title AS text FROM va UNION ALL SELECT id, 'search', 'text', substr(sha256(body), 1, 8) FROM va")
def sk13(spark, d):
    rows = valid(spark, d).select("id", "title", F.substring(F.sha2("body", 256), 1, 8).alias("hash"))
    return sinks.outputs(rows, "id", {"title": ("site", "title"), "hash": ("search", "text")})


@query("sk9_markdown")
def sk9(spark, d):
    return valid(spark, d).select("id", markup.markdown("body").alias("markdown"))


@query("sk10_html")
def sk10(spark, d):
    return valid(spark, d).select("id", markup.html("body").alias("html"))


@query("sk11_tei")
def sk11(spark, d):
    made = valid(spark, d).select("id", markup.tei("body", "title", "volume", X.page_range("page_start", "page_end")).alias("tei"))
    return made.withColumn("well_formed", markup.well_formed("tei"))


# --- predicates --------------------------------------------------------------------------------


@query("pf1_page_range", "WITH r AS (SELECT volume, min(page_start) AS lo, max(page_end) AS hi FROM articles WHERE volume <> 5 GROUP BY 1) SELECT DISTINCT p.id, coalesce(p.page_number BETWEEN r.lo AND r.hi, TRUE) AS inside FROM source_pages p LEFT JOIN r USING (volume)")
def pf1(spark, d):
    ranges = table(spark, d, "articles").where("volume <> 5").groupBy("volume").agg(F.min("page_start").alias("lo"), F.max("page_end").alias("hi"))
    return table(spark, d, "source_pages").join(ranges, "volume", "left").select("id", F.coalesce(F.col("page_number").between(F.col("lo"), F.col("hi")), F.lit(True)).alias("inside")).distinct()


_FOLIO = "coalesce(nullif(regexp_extract(wikitext, '\\{\\{rh\\|(\\d+)\\|', 1), ''), nullif(regexp_extract(wikitext, '\\{\\{rh\\|[^|]*\\|[^|]*\\|(\\d+)\\}\\}', 1), ''), nullif(regexp_extract(wikitext, 'Heading\\|[^|]*\\|[^|]*\\|([0-9ivxlc]+)\\}\\}', 1), ''), nullif(regexp_extract(wikitext, '\\{\\{rh\\|([ivxlc]+)\\|', 1), ''), nullif(regexp_extract(wikitext, '\\{\\{c\\|(\\d+)\\}\\}', 1), ''))"


def folio(c):
    """The printed page in a running head: figures at a side before numerals, the middle only if it is a number."""
    ladder = [r"\{\{rh\|(\d+)\|", r"\{\{rh\|[^|]*\|[^|]*\|(\d+)\}\}", r"Heading\|[^|]*\|[^|]*\|([0-9ivxlc]+)\}\}", r"\{\{rh\|([ivxlc]+)\|", r"\{\{c\|(\d+)\}\}"]
    return F.coalesce(*[F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in ladder])


@query("pf3_folio", f"SELECT DISTINCT id, {_FOLIO} AS folio FROM source_pages")
def pf3(spark, d):
    return table(spark, d, "source_pages").select("id", folio("wikitext").alias("folio")).distinct()


@query("pf2_plate_pages", f"SELECT DISTINCT id, {_FOLIO} IS NULL AND coalesce(contains(raw_text, '[Image of leaf'), FALSE) AND NOT coalesce(contains(wikitext, 'front matter'), FALSE) AS plate FROM source_pages")
def pf2(spark, d):
    image, front = F.coalesce(F.col("raw_text").contains("[Image of leaf"), F.lit(False)), F.coalesce(F.col("wikitext").contains("front matter"), F.lit(False))
    return table(spark, d, "source_pages").select("id", (folio("wikitext").isNull() & image & ~front).alias("plate")).distinct()


@query("pf4_banner_first", "SELECT DISTINCT id, strpos(raw_text, 'VOL.') > 0 AND (strpos(raw_text, '[Image') = 0 OR strpos(raw_text, 'VOL.') < strpos(raw_text, '[Image')) AS front FROM source_pages")
def pf4(spark, d):
    banner, image = F.instr("raw_text", "VOL."), F.instr("raw_text", "[Image")
    return table(spark, d, "source_pages").select("id", ((banner > 0) & ((image == 0) | (banner < image))).alias("front")).distinct()


@query("pf5_title_block", "SELECT heading_id, length(heading) >= 2 AND NOT regexp_matches(heading, '^[0-9]') AND NOT regexp_matches(heading, '^[IVXLCDM]+\\.?$') AND NOT regexp_matches(heading, '\\b[A-Z][a-z]+\\b') AND regexp_matches(heading, '^[^a-z ]+') AS is_title FROM headings")
def pf5(spark, d):
    h = F.col("heading")
    ok = (F.length(h) >= 2) & ~h.rlike("^[0-9]") & ~h.rlike(r"^[IVXLCDM]+\.?$") & ~h.rlike(r"\b[A-Z][a-z]+\b") & h.rlike("^[^a-z ]+")
    return table(spark, d, "headings").select("heading_id", ok.alias("is_title"))


#: Single words that are never a target.
NO_TARGET = "a above also although an and at bel below but by dr emperor for founded further he her his in is it its not of on or s son spread the their these they this those to under was were which with".split()
#: What a target never has.
_REJECT = [
    r"^(?i)(also|although|and|especially|for|further|particularly|separate|the)\b", r"\b(p\.|pp\.|vol\.|Ber\.|Journ\.|Proc\.|Hist\.|Dict\.|Biog\.|Gesch\.|Zeits\.|\d{4})", r"'s\s+(Dict|Hist|Bibl|Life|Lives|Memoir)", ";", r"^\s*(?i):[a-z]{2,3}:",
    r"(?i)^[A-Z]\.[A-Z]\.[A-Z]\.,?\s*[A-Z]?\.\s*[ivxlcdm]+\b",
]


@query("pf6_plausible_target", """WITH t AS (SELECT DISTINCT normalized_target AS t, lower(normalized_target) AS l FROM xrefs WHERE normalized_target IS NOT NULL) SELECT t, length(t) BETWEEN 3 AND 200
AND l NOT IN ('above', 'also', 'although', 'and', 'bel', 'below', 'but', 'emperor', 'for', 'founded', 'further', 'her', 'his', 'its', 'not', 'son', 'spread', 'the', 'their', 'these', 'they', 'this', 'those', 'under', 'was', 'were', 'which', 'with')
AND NOT regexp_matches(l, '^(also|although|and|especially|for|further|particularly|separate|the)\\b') AND NOT regexp_matches(t, '\\bpp?\\.|\\bvol\\.|\\b(Ber|Journ|Proc|Hist|Dict|Biog|Gesch|Zeits)\\.|\\b[0-9]{4}') AND NOT regexp_matches(t, chr(39) || 's\\s+(Dict|Hist|Bibl|Life|Lives|Memoir)') AND NOT contains(t, ';')
AND NOT regexp_matches(l, '^\\s*:[a-z][a-z][a-z]?:') AND NOT (length(t) < 13 AND regexp_matches(t, '\\b[A-Z]\\.?\\s*$')) AND NOT regexp_matches(l, '^[a-z]\\.[a-z]\\.[a-z]\\.,?\\s*[a-z]?\\.\\s*[ivxlcdm]+\\b') AS plausible FROM t""")
def pf6(spark, d):
    t = F.col("t")
    bad = F.lower(t).isin(*NO_TARGET) | (F.length(t) <= 2) | (F.length(t) > 200) | ((F.length(t) <= 12) & t.rlike(r"\b[A-Z]\.?\s*$"))
    for p in _REJECT:
        bad = bad | t.rlike(p)
    return table(spark, d, "xrefs").where("normalized_target IS NOT NULL").select(F.col("normalized_target").alias("t")).distinct().select("t", (~bad).alias("plausible"))


@query("pf7_article_type", f"WITH {VA} SELECT id, CASE WHEN article_type = 'plate' THEN 'plate' WHEN trim(body) <> '' THEN 'article' ELSE 'front_matter' END AS kind FROM va")
def pf7(spark, d):
    return valid(spark, d).select("id", F.when(F.col("article_type") == "plate", "plate").when(F.trim("body") != "", "article").otherwise("front_matter").alias("kind"))


#: Nouns by which an article says what it is about, and the kinds they mean.
LEAD_NOUNS = {
    "capital": "city", "chief town": "city", "chief city": "city", "seaport": "town", "town": "town", "city": "city", "borough": "town", "village": "town", "watering-place": "town",
    "canton": "division", "county": "division", "shire": "division", "province": "division", "department": "division", "government": "division", "district": "division", "kingdom": "division", "duchy": "division",
    "principality": "division", "governorate": "division", "prefecture": "division", "arrondissement": "division", "state": "division", "commonwealth": "division",
    "river": "river", "stream": "river", "tributary": "river", "affluent": "river", "lake": "lake", "loch": "lake", "lough": "lake", "mountain": "mountain", "peak": "mountain", "volcano": "mountain",
    "island": "island", "isle": "island", "archipelago": "island",
    "chemist": "chemist", "mathematician": "mathematician", "physicist": "physicist", "astronomer": "astronomer", "naturalist": "naturalist", "zoologist": "naturalist", "botanist": "naturalist", "geologist": "geologist",
    "philosopher": "philosopher", "historian": "historian", "theologian": "theologian", "divine": "theologian", "poet": "poet", "novelist": "writer", "dramatist": "writer", "playwright": "writer", "author": "writer",
    "painter": "painter", "sculptor": "sculptor", "architect": "architect", "composer": "musician", "musician": "musician", "organist": "musician", "physician": "physician", "surgeon": "physician",
    "general": "general", "admiral": "admiral", "statesman": "statesman", "politician": "statesman", "engineer": "engineer", "king": "king", "emperor": "emperor", "pope": "pope", "saint": "saint", "bishop": "bishop",
    "actor": "actor", "actress": "actor", "tragedian": "actor", "comedian": "actor", "dancer": "actor",
    "tribe": "ethnic", "people": "ethnic", "race": "ethnic", "nation": "ethnic", "caste": "ethnic", "nomad": "ethnic",
    "bird": "nature", "mammal": "nature", "fish": "nature", "insect": "nature", "plant": "nature", "genus": "nature", "tree": "nature", "shrub": "nature", "reptile": "nature", "mollusc": "nature", "fungus": "nature",
    "flower": "nature", "batrachian": "nature",
}


def lead_kind(text):
    """The kind of the first noun of the list in the first 220 characters; plurals only in *one of the ...s*.

    The nouns are looked for in one pass; of those at one place the longest counts.
    """
    head = F.lower(F.substring(text, 1, 220))
    nouns = "|".join(sorted(LEAD_NOUNS, key=lambda w: (-len(w), w)))
    said = F.regexp_extract(head, rf"(?:^|[^a-z])(?:one of[^.]{{0,30}}?[^a-z]({nouns})s|({nouns}))(?:[^a-z]|$)", 0)
    noun = F.regexp_extract(said, rf"({nouns})s?[^a-z]?$", 1)
    kinds = F.create_map(*[F.lit(x) for pair in LEAD_NOUNS.items() for x in pair])
    return F.when(noun != "", F.try_element_at(kinds, noun))


_NOUNS = "n AS (SELECT * FROM (VALUES " + ", ".join(f"('{w}', '{k}')" for w, k in LEAD_NOUNS.items()) + ") AS v(noun, kind))"


@query("pf8_lead_kind", f"""WITH {VA}, {_NOUNS}, h AS (SELECT id, lower(substr(trim(regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(body, '(?s)«FN(\\[[^«»]*\\])?:.*?«/FN»', '', 'g'), '«(LN|AL|XL)(\\[[^«»]*\\])?:([^«»|]*\\|)*([^«»|]*)(»|«/(LN|AL|XL)»)', '\\4', 'g'), '«P»', ' '), '«/?[A-Z][A-Za-z0-9_]*(\\[[^«»]*\\])?(:[^«»]*»|:|»)', '', 'g'), '\\s+', ' ', 'g')), 1, 220)) AS h FROM va),
m AS (SELECT id, kind, noun, length(regexp_extract(h, '^(.*?)(?:^|[^a-z])(' || noun || '|one of[^.]{{0,30}}?[^a-z]' || noun || 's)(?:[^a-z]|$)', 1)) AS at FROM h, n WHERE regexp_matches(h, '(?:^|[^a-z])(' || noun || '|one of[^.]{{0,30}}?[^a-z]' || noun || 's)(?:[^a-z]|$)'))
SELECT h.id, min_by(m.kind, (m.at, -length(m.noun))) AS kind FROM h LEFT JOIN m USING (id) GROUP BY h.id""")
def pf8(spark, d):
    return valid(spark, d).select("id", lead_kind(X.opening("body")).alias("kind"))


#: Kinds that are persons.
PERSON_KINDS = "chemist mathematician physicist astronomer naturalist geologist philosopher historian theologian poet writer painter sculptor architect musician physician general admiral statesman engineer king emperor pope saint bishop actor".split()


def kind_qualifies(kind, wanted):
    """Whether the kind of an article satisfies the wanted one; ``PERSON`` is any person, a *town* may be a city."""
    fits = F.when(wanted == "PERSON", kind.isin(*PERSON_KINDS)).when(wanted == "town", kind.isin("town", "city")).otherwise(kind == wanted)
    return F.coalesce(fits, F.lit(False))


@query("pf9_kind_qualifies", f"WITH k AS (SELECT id, kind FROM ({SQL['pf8_lead_kind']})), w AS (SELECT unnest(['PERSON', 'town', 'river', 'division', 'nature']) AS wanted) SELECT wanted, kind, count(*) AS n, coalesce(CASE wanted WHEN 'PERSON' THEN kind NOT IN ('division', 'town', 'city', 'lake', 'river', 'mountain', 'island', 'ethnic', 'nature') WHEN 'town' THEN kind IN ('town', 'city') ELSE kind = wanted END, FALSE) AS fits FROM k, w GROUP BY ALL")
def pf9(spark, d):
    """How many articles of each kind satisfy what some buckets want."""
    kinds = pf8(spark, d).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    asked = kinds.select("kind", "n", F.explode(F.array(*map(F.lit, ("PERSON", "town", "river", "division", "nature")))).alias("wanted"))
    return asked.select("wanted", "kind", "n", kind_qualifies(F.col("kind"), F.col("wanted")).alias("fits"))


@query("pf10_institutional", "SELECT DISTINCT title, regexp_matches(title, '(?i),\\s*(UNIVERSITY|COLLEGE|BATTLE|TREATY|COUNCIL|SIEGE|CONVENTION|SYNOD|DIET|ORDER|CONFERENCE|ACT)\\b') AS institutional FROM articles")
def pf10(spark, d):
    return table(spark, d, "articles").select("title", F.col("title").rlike(r"(?i),\s*(UNIVERSITY|COLLEGE|BATTLE|TREATY|COUNCIL|SIEGE|CONVENTION|SYNOD|DIET|ORDER|CONFERENCE|ACT)\b").alias("institutional")).distinct()


@query("pf11_wanted_kinds", "SELECT heading_id, CASE WHEN contains(heading, '(RIVER)') THEN 'river' WHEN contains(heading, '(TOWN)') THEN 'town' WHEN regexp_matches(heading, '(DUCHY|KINGDOM|PRINCIPALITY|BISHOPRIC) OF$') THEN 'division' WHEN category = 'biography' THEN 'PERSON' ELSE category END AS wanted FROM headings")
def pf11(spark, d):
    h = F.col("heading")
    wanted = F.when(h.contains("(RIVER)"), "river").when(h.contains("(TOWN)"), "town").when(h.rlike("(DUCHY|KINGDOM|PRINCIPALITY|BISHOPRIC) OF$"), "division").when(F.col("category") == "biography", "PERSON").otherwise(F.col("category"))
    return table(spark, d, "headings").select("heading_id", wanted.alias("wanted"))


@query("pf12_source_quality", f"WITH {VA}, p AS (SELECT DISTINCT volume, page_number, CASE WHEN wikitext IS NULL THEN 1 ELSE 3 END AS level FROM source_pages) SELECT va.id, min(level) AS lowest, count(*) FILTER (level = 1) AS unproofed, count(*) AS n_pages FROM va JOIN p ON p.volume = va.volume AND p.page_number BETWEEN va.page_start AND va.page_end GROUP BY va.id")
def pf12(spark, d):
    level = F.when(F.col("wikitext").isNull(), 1).otherwise(3)
    pages = table(spark, d, "source_pages").select("volume", "page_number", level.alias("level")).distinct()
    met = range_join(valid(spark, d).select("id", "volume", "page_start", "page_end"), pages, ["volume"], "page_start", "page_end", "page_number")
    return met.groupBy("id").agg(F.min("level").alias("lowest"), F.count_if(F.col("level") == 1).alias("unproofed"), F.count(F.lit(1)).alias("n_pages"))


@query("pf13_preview", f"WITH {VA}, p AS (SELECT id, string_split(regexp_replace(trim(regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(body, '(?s)«FN(\\[[^«»]*\\])?:.*?«/FN»', '', 'g'), '«(LN|AL|XL)(\\[[^«»]*\\])?:([^«»|]*\\|)*([^«»|]*)(»|«/(LN|AL|XL)»)', '\\4', 'g'), '«P»', ' '), '«/?[A-Z][A-Za-z0-9_]*(\\[[^«»]*\\])?(:[^«»]*»|:|»)', '', 'g'), '\\s+', ' ', 'g')), '^\\s*\\([^)]*\\)\\s*', ''), ' ') AS w FROM va) SELECT id, CASE WHEN len(w) > 12 THEN array_to_string(w[1:12], ' ') || '…' ELSE array_to_string(w, ' ') END AS preview FROM p")
def pf13(spark, d):
    words = F.split(F.regexp_replace(X.plain_text("body"), r"^\s*\([^)]*\)\s*", ""), " ")
    return valid(spark, d).select("id", F.when(F.size(words) > 12, F.concat(F.array_join(F.slice(words, 1, 12), " "), F.lit("…"))).otherwise(F.array_join(words, " ")).alias("preview"))


@query("pf14_missing_stop", f"WITH {VA} SELECT id, len(regexp_extract_all(body, '[a-z]{{3}} (The|Its|His|They) [a-z]')) AS hits FROM va")
def pf14(spark, d):
    return valid(spark, d).select("id", F.size(F.regexp_extract_all("body", F.lit("[a-z]{3} (The|Its|His|They) [a-z]"), F.lit(0))).cast("bigint").alias("hits"))


#: Words in brackets after a credit and the kinds they mean.
CREDIT_KINDS = {
    "king": "king", "kings": "king", "emperor": "emperor", "emperors": "emperor", "pope": "pope", "popes": "pope", "saint": "saint", "st": "saint", "general": "general", "statesman": "statesman", "poet": "poet",
    "painter": "painter", "sculptor": "sculptor", "composer": "musician", "musician": "musician", "physician": "physician", "bishop": "bishop", "family": "family", "tribe": "ethnic", "people": "ethnic",
}


def credit_kinds(title):
    """The kinds that a credit implies, sorted: by the words of its brackets, and ``person`` where a name follows a comma."""
    words = F.flatten(F.transform(F.regexp_extract_all(F.lower(title), F.lit(r"\(([^)]*)\)"), F.lit(1)), lambda p: F.split(p, "[^a-z]+")))
    known = F.create_map(*[F.lit(x) for pair in CREDIT_KINDS.items() for x in pair])
    named = F.array(F.when(title.rlike(r",\s*\p{Lu}[\p{L}.'-]+(\s+\p{Lu}[\p{L}.'-]*)*\s*(\(.*\))?$"), F.lit("person")))
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(F.transform(words, lambda w: F.try_element_at(known, w)), named))))


@query("pf16_credit_kinds", r"""WITH t AS (SELECT heading_id, heading AS t FROM headings), k AS (SELECT * FROM (VALUES ('king', 'king'), ('kings', 'king'), ('emperor', 'emperor'), ('emperors', 'emperor'), ('pope', 'pope'), ('popes', 'pope'), ('saint', 'saint'), ('st', 'saint'), ('general', 'general'), ('statesman', 'statesman'), ('poet', 'poet'), ('painter', 'painter'), ('sculptor', 'sculptor'),
('composer', 'musician'), ('musician', 'musician'), ('physician', 'physician'), ('bishop', 'bishop'), ('family', 'family'), ('tribe', 'ethnic'), ('people', 'ethnic')) AS v(word, kind)), b AS (SELECT heading_id, unnest(regexp_extract_all(lower(t), '\(([^)]*)\)', 1)) AS b FROM t), w AS (SELECT heading_id, unnest(regexp_split_to_array(b, '[^a-z]+')) AS word FROM b),
f AS (SELECT heading_id, kind FROM w JOIN k USING (word) UNION SELECT heading_id, 'person' FROM t WHERE regexp_matches(t, ',\s*\p{Lu}[\p{L}.''-]+(\s+\p{Lu}[\p{L}.''-]*)*\s*(\(.*\))?$')) SELECT heading_id, string_agg(kind, ',' ORDER BY kind) AS kinds FROM f GROUP BY 1""")
def pf16(spark, d):
    kinds = table(spark, d, "headings").select("heading_id", credit_kinds(F.col("heading")).alias("k")).where(F.size("k") > 0)
    return kinds.select("heading_id", F.array_join("k", ",").alias("kinds"))


# --- structure ---------------------------------------------------------------------------------


@query("tx8_elements")
def tx8(spark, d):
    pages = once(spark, d, "source_pages", "id", "wikitext").where("wikitext IS NOT NULL")
    return pages.select("id", F.explode(markup.elements("wikitext")).alias("e")).select("id", "e.path", "e.depth", "e.ord", "e.label", "e.raw")


@query("tx9_produce")
def tx9(spark, d):
    return once(spark, d, "source_pages", "id", "wikitext").where("wikitext IS NOT NULL").select("id", markup.produce("wikitext").alias("stream"))


@query("tx10_label_counts")
def tx10(spark, d):
    return tx8(spark, d).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("tx4_titles", f"WITH {VA} SELECT id, regexp_replace(regexp_extract(body, '^\\s*(«B»[^«»]*«/B»)', 1), '«/?B»', '', 'g') AS carved FROM va")
def tx4(spark, d):
    return valid(spark, d).select("id", F.regexp_replace(F.regexp_extract("body", r"^\s*(«B»[^«»]*«/B»)", 1), "«/?B»", "").alias("carved"))


_STREAM = f"""WITH {VA}, p AS (SELECT DISTINCT volume, page_number, 2 * id AS page_id, coalesce(wikitext, raw_text, '') AS t FROM source_pages UNION ALL SELECT volume, page_start, 2 * id + 1, coalesce(body, '') FROM va),
b AS (SELECT volume, page_number, page_id, unnest(range(1, len(s) + 1)) AS i, unnest(s) AS block, regexp_extract(unnest(s), '^(?:\\s|<noinclude>.*?</noinclude>)*«B»((?:[^«]|«/?I»)*?)«/B»', 1) AS raw FROM (SELECT *, regexp_split_to_array(t, '\\n[^\\S\\n]*\\n') AS s FROM p)),
h AS (SELECT *, trim(regexp_replace(regexp_replace(raw, '«/?I»', '', 'g'), '\\s*\\([^)]*\\)', '', 'g'), ' ,.;:') AS title FROM b),
k AS (SELECT *, length(title) >= 2 AND NOT regexp_matches(title, '^[0-9]|[A-Za-z][0-9]|[0-9][A-Za-z]|^[IVXLCDM]+\\.?$|(^|[ ,])[A-ZÀ-Þ][a-zà-ÿ][a-zà-ÿ-]*([ ,.]|$)') AND regexp_matches(title, '^[^ ,a-z]') AS starts FROM h),
n AS (SELECT *, sum(starts::INT) OVER (PARTITION BY volume ORDER BY page_number, page_id, i) AS article_no FROM k)"""


@query("tx1_boundaries", f"{_STREAM} SELECT volume, article_no::BIGINT AS article_no, max(CASE WHEN starts THEN title END) AS title, min(page_number) AS page_start FROM n WHERE article_no > 0 GROUP BY ALL")
def tx1_boundaries(spark, d):
    """All articles that the volumes hold when the scanned pages and the valid bodies are read in page order as one stream."""
    return walk_volumes(_stream(spark, d)).select("volume", "article_no", "title", "page_start")


def _stream(spark, d):
    pages = table(spark, d, "source_pages").select((2 * F.col("id")).alias("page_id"), "volume", "page_number", F.coalesce("wikitext", "raw_text").alias("text")).dropDuplicates(["page_id"])
    return pages.unionByName(valid(spark, d).select((2 * F.col("id") + 1).alias("page_id"), "volume", F.col("page_start").alias("page_number"), F.col("body").alias("text")))


@query("tx1_segments", f"{_STREAM} SELECT volume, article_no::BIGINT AS article_no, count(DISTINCT page_id) AS n_pages, max(page_number) AS page_end FROM n WHERE article_no > 0 AND (starts OR trim(block, ' ' || chr(10)) <> '') GROUP BY ALL")
def tx1_segments(spark, d):
    """How many pages each of these articles goes over, and the last one."""
    walked = walk_volumes(_stream(spark, d))
    return walked.select("volume", "article_no", F.size(F.array_distinct("segments.page_id")).cast("bigint").alias("n_pages"), "page_end")


@query("tx1_walk", f"WITH {VA} SELECT volume, count(*) AS n_articles, count(*) FILTER (starts_with(ltrim(body), '«B»')) AS titled FROM va GROUP BY volume")
def tx1(spark, d):
    return valid(spark, d).groupBy("volume").agg(F.count(F.lit(1)).alias("n_articles"), F.count_if(F.ltrim("body").startswith("«B»")).alias("titled"))


@query("tx2_plates_first", f"SELECT DISTINCT volume, page_number, CASE WHEN {_FOLIO} IS NULL AND coalesce(contains(raw_text, '[Image of leaf'), FALSE) AND NOT coalesce(contains(wikitext, 'front matter'), FALSE) THEN 'plate' ELSE 'text' END AS part FROM source_pages WHERE trim(coalesce(wikitext, raw_text, ''), ' ' || chr(10)) <> ''")
def tx2(spark, d):
    """The pages that are not blank, divided into plates and those that the walk cuts into articles."""
    image, front = F.coalesce(F.col("raw_text").contains("[Image of leaf"), F.lit(False)), F.coalesce(F.col("wikitext").contains("front matter"), F.lit(False))
    pages = table(spark, d, "source_pages").where(F.trim(F.coalesce("wikitext", "raw_text", F.lit("")), F.lit(" \n")) != "")
    return pages.select("volume", "page_number", F.when(folio("wikitext").isNull() & image & ~front, "plate").otherwise("text").alias("part")).distinct()


@query("tx3_plate_titles", f"WITH {VA} SELECT id, title, coalesce(nullif(regexp_extract(title, 'PLATE ([IVXLC]+)', 1), ''), nullif(regexp_extract(section_name, 's(\\d+)', 1), ''), '-') AS number FROM va WHERE article_type = 'plate'")
def tx3(spark, d):
    number = F.coalesce(F.nullif(F.regexp_extract("title", "PLATE ([IVXLC]+)", 1), F.lit("")), F.nullif(F.regexp_extract("section_name", r"s(\d+)", 1), F.lit("")), F.lit("-"))
    return valid(spark, d).where("article_type = 'plate'").select("id", "title", number.alias("number"))


@query("tx14_notes", f"WITH {VA} SELECT id, row_number() OVER (PARTITION BY id ORDER BY i) AS number, note FROM (SELECT id, unnest(range(1, len(n) + 1)) AS i, unnest(n) AS note FROM (SELECT id, regexp_extract_all(body, '«FN:([^«»]*)«/FN»', 1) AS n FROM va))")
def tx14(spark, d):
    """The notes of every article under one numbering; those of a name are one note."""
    return valid(spark, d).select("id", F.explode(markup.notes("body")).alias("n")).select("id", F.col("n.number").cast("bigint").alias("number"), F.col("n.text").alias("note"))


@query("tx16_sections", r"WITH l AS (SELECT id, unnest(range(0, len(s))) AS i, unnest(s) AS line FROM (SELECT DISTINCT id, string_split(raw_text, chr(10)) AS s FROM source_pages)) SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS INT) AS pos, 'anchor' AS kind, 3 AS level, line AS name FROM l WHERE regexp_matches(line, '^[A-Z]{4,}$')")
def tx16(spark, d):
    """The sections of every page whose headings stand on lines of their own: the lines become anchors, and the stream that is produced tells them in order."""
    marked = once(spark, d, "source_pages", "id", "raw_text").select("id", F.regexp_replace("raw_text", r"(?m)^([A-Z]{4,})$", "{{anchor|$1}}").alias("t"))
    return marked.select("id", F.posexplode(markup.sections(markup.produce("t"))).alias("pos", "s")).select("id", "pos", "s.kind", "s.level", "s.name")


@query("tx17_references", f"""WITH {VA}, l AS (SELECT id, regexp_extract_all(body, '«LN:([^«»|]*)[^«»]*', 1) AS t FROM va), e AS (SELECT id, unnest(range(1, len(t) + 1)) AS i, trim(unnest(t)) AS target FROM l)
SELECT id, upper(target) AS target, min(i) - 1 AS place, count(*) AS n FROM e WHERE target <> '' GROUP BY 1, 2""")
def tx17(spark, d):
    links = valid(spark, d).select("id", F.posexplode(markup.links("body")).alias("pos", "l")).where("l.type = 'link'").select("id", "pos", F.upper(F.trim("l.target")).alias("target"))
    return links.where("target <> ''").groupBy("id", "target").agg(F.min("pos").cast("bigint").alias("place"), F.count(F.lit(1)).alias("n"))


@query("tx11_see_windows", "SELECT doc_id, trim(unnest(regexp_extract_all(text, '\\(see ([A-Z][^()]{2,80})\\)', 1))) AS target FROM documents")
def tx11(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\(see ([A-Z][^()]{2,80})\)"), F.lit(1))).alias("t")).select("doc_id", F.trim("t").alias("target"))


@query("tx12_tables", r"WITH d AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^[^|{}\[\]<«]+(\|[^|{}\[\]<«]+)+$')) AS s FROM documents), l AS (SELECT doc_id, unnest(range(0, len(s))) AS row, string_split(unnest(s), '|') AS c FROM d) SELECT doc_id, CAST(row AS INT) AS row, CAST(unnest(range(0, len(c))) AS INT) AS col, trim(unnest(c), ' ' || chr(9) || chr(13) || chr(160)) AS text FROM l")
def tx12(spark, d):
    """The tabular lines of the documents as tables in bar syntax, recognised, produced and read back as grids."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"^[^|{}\[\]<«]+(\|[^|{}\[\]<«]+)+$"))
    docs = table(spark, d, "documents").select("doc_id", lines.alias("l")).where(F.size("l") > 0)
    source = F.concat(F.lit("{|\n"), F.array_join(F.transform("l", lambda x: F.concat(F.lit("| "), F.replace(x, F.lit("|"), F.lit(" || ")))), "\n|-\n"), F.lit("\n|}"))
    return docs.select("doc_id", F.explode(markup.cells(markup.produce(source))).alias("c")).select("doc_id", "c.row", "c.col", "c.text")


@query("tx15_section_anchors", "WITH l AS (SELECT id, unnest(range(0, len(s))) AS pos, unnest(s) AS name FROM (SELECT DISTINCT id, string_split(raw_text, chr(10)) AS s FROM source_pages)) SELECT DISTINCT id, CAST(pos AS INT) AS pos, name, lower(name) AS slug FROM l WHERE regexp_matches(name, '^[A-Z]{4,}$')")
def tx15(spark, d):
    """Lines of capitals that stand alone in the pages, as anchors."""
    lines = table(spark, d, "source_pages").select("id", F.posexplode(F.split("raw_text", "\n")).alias("pos", "line")).where(F.col("line").rlike("^[A-Z]{4,}$"))
    return lines.select("id", "pos", F.col("line").alias("name"), X.slug("line").alias("slug")).distinct()


@query("tx25_crossing_spans", """WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS a, epoch_us(ts) + CAST(abs(value) * 1000000 AS BIGINT) * 60 AS b FROM events WHERE value IS NOT NULL)
SELECT x.event_id AS first_id, y.event_id AS second_id FROM e x JOIN e y ON x.user_id = y.user_id AND x.a < y.a AND y.a < x.b AND x.b < y.b""")
def tx25(spark, d):
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    e = table(spark, d, "events").where("value IS NOT NULL").select("event_id", "user_id", start.alias("a"), (start + F.round(F.abs("value") * 1000000).cast("bigint") * 60).alias("b"))
    # cells of an hour: a span meets only the beginnings in the hours that it touches
    ends = e.select(F.col("event_id").alias("second_id"), "user_id", F.col("a").alias("ya"), F.col("b").alias("yb"))
    met = range_join(e, ends, ["user_id"], "a", "b", "ya", 3_600_000_000).where("a < ya AND ya < b AND b < yb")
    return met.select(F.col("event_id").alias("first_id"), "second_id")


@query("tx25_dangling")
def tx25_dangling(spark, d):
    """Marks without their other half in the documents, which are pieces of marked texts, and in the references."""
    docs = table(spark, d, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    refs = once(spark, d, "xrefs", "id", "surface_text").select(F.lit("reference").alias("kind"), "id", F.col("surface_text").alias("text"))
    return docs.unionByName(refs).select("kind", "id", F.explode(markup.dangling("text")).alias("mark"))


@query("tx26_leaks", r"""WITH f AS (SELECT doc_id, 'attr' AS leak FROM documents WHERE regexp_matches(text, '\b(style|align|valign|colspan|rowspan|bgcolor|scope|cellpadding|cellspacing|width|height)=') UNION ALL SELECT doc_id, 'marker' FROM documents WHERE regexp_matches(text, '«/?[A-Z]\w*(\[|:|»)')
UNION ALL SELECT doc_id, 'sentinel' FROM documents WHERE contains(text, chr(1)) OR contains(text, chr(2)) OR contains(text, chr(3)) UNION ALL SELECT doc_id, 'template' FROM documents WHERE contains(text, '{{') OR contains(text, '}}') UNION ALL SELECT doc_id, 'wikilink' FROM documents WHERE contains(text, '[[') OR contains(text, ']]'))
SELECT doc_id, string_agg(leak, ',' ORDER BY leak) AS leaks FROM f GROUP BY doc_id""")
def tx26(spark, d):
    """What the documents, as plain texts, hold that is no text."""
    return table(spark, d, "documents").select("doc_id", find_leaks(F.col("text"), "text").alias("l")).where(F.size("l") > 0).select("doc_id", F.array_join("l", ",").alias("leaks"))


@query("tx26_output_leaks")
def tx26_outputs(spark, d):
    """How many pages leak what in each of the three outputs that are made of them."""
    stream = once(spark, d, "source_pages", "id", "wikitext").where("wikitext IS NOT NULL").select("id", markup.produce("wikitext").alias("s"))
    made = stream.select("id", markup.html("s").alias("html"), markup.markdown("s").alias("markdown"), X.plain_text("s").alias("text"))
    found = [F.struct(F.lit(f).alias("fmt"), find_leaks(F.col(f), f).alias("leaks")) for f in ("html", "markdown", "text")]
    rows = made.select("id", F.explode(F.array(*found)).alias("f")).select("id", "f.fmt", F.explode("f.leaks").alias("leak"))
    leaks = rows.groupBy("fmt", "leak").agg(F.countDistinct("id").alias("n"))
    return made.agg(F.count(F.lit(1)).alias("n")).select(F.lit("all").alias("fmt"), F.lit("pages").alias("leak"), "n").unionByName(leaks)


@query("tx27_mangled", f"WITH {VA} SELECT id, len(regexp_extract_all(regexp_replace(body, '«/?[A-Z][A-Za-z0-9_]*(\\[[^«»]*\\])?(:[^«»]*»|:|»)', ' ', 'g'), '[«»]')) AS stray FROM va")
def tx27(spark, d):
    return valid(spark, d).select("id", F.size(F.regexp_extract_all(X.strip_markers("body"), F.lit("[«»]"), F.lit(0))).cast("bigint").alias("stray"))


@query("tx28_triage", f"WITH {VA} SELECT id, CASE WHEN contains(body, '{{{{') THEN 'source' WHEN regexp_matches(body, '«/?[a-z]') THEN 'producer' ELSE 'clean' END AS verdict FROM va")
def tx28(spark, d):
    return valid(spark, d).select("id", F.when(F.col("body").contains("{{"), "source").when(F.col("body").rlike("«/?[a-z]"), "producer").otherwise("clean").alias("verdict"))


@query("tx29_folded_rows", "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), c AS (SELECT doc_id, len(string_split(line, '|')) AS n FROM l WHERE contains(line, '|')) SELECT doc_id, min(n) AS cells FROM c GROUP BY 1 HAVING min(n) = max(n) AND count(*) > 1")
def tx29(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").contains("|"))
    n = F.size(F.split("line", r"\|"))
    return lines.groupBy("doc_id").agg(F.min(n).cast("bigint").alias("cells"), F.max(n).alias("most"), F.count(F.lit(1)).alias("k")).where("cells = most AND k > 1").select("doc_id", "cells")
