"""Aggregations, windows, sorts and set operations over the corpus."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexiloom.functions import text as X
from lexiloom.functions.leaks import find_leaks
from lexiloom.functions.types import rows
from lexiloom.operators import sequence, votes
from lexiloom.operators.intervals import first_wins
from lexiloom.operators.ordered import running_sum
from lexiloom.plans.common import VA, VC, Registry, once, valid
from lexiloom.tables import table

query = Registry()
QUERIES, SQL = query.queries, query.sql

_NK = "array_to_string(list_sort(list_filter(regexp_split_to_array(lower(strip_accents({0})), '[^a-z]+'), lambda w: w <> '')), ' ')"


def name_key(c):
    return F.array_join(F.array_sort(F.filter(F.split(F.lower(X.fold_accents(c)), "[^a-z]+"), lambda w: w != "")), " ")


@query("ag1_hyphen_map", """WITH w AS (SELECT lower(unnest(regexp_extract_all(raw_text, '[A-Za-z]+-[A-Za-z]+'))) AS pair FROM (SELECT DISTINCT id, raw_text FROM source_pages)),
h AS (SELECT replace(pair, '-', '') AS solid, pair, count(*) AS hyphened FROM w GROUP BY 1, 2), s AS (SELECT lower(unnest(regexp_extract_all(raw_text, '[A-Za-z]+'))) AS solid FROM (SELECT DISTINCT id, raw_text FROM source_pages)), c AS (SELECT solid, count(*) AS n FROM s GROUP BY 1)
SELECT pair, hyphened, coalesce(c.n, 0) AS solid_n, CASE WHEN coalesce(c.n, 0) > hyphened THEN 'drop' ELSE 'keep' END AS verdict FROM h LEFT JOIN c USING (solid)""")
def ag1(spark, d):
    text = once(spark, d, "source_pages", "id", "raw_text")
    pairs = text.select(F.explode(F.regexp_extract_all("raw_text", F.lit("[A-Za-z]+-[A-Za-z]+"), F.lit(0))).alias("p")).select(F.lower("p").alias("pair"))
    hyphened = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("hyphened")).withColumn("solid", F.replace("pair", F.lit("-"), F.lit("")))
    words = text.select(F.explode(F.regexp_extract_all("raw_text", F.lit("[A-Za-z]+"), F.lit(0))).alias("w")).groupBy(F.lower("w").alias("solid")).agg(F.count(F.lit(1)).alias("n"))
    both = hyphened.join(words, "solid", "left").withColumn("solid_n", F.coalesce("n", F.lit(0)))
    return both.select("pair", "hyphened", "solid_n", F.when(F.col("solid_n") > F.col("hyphened"), "drop").otherwise("keep").alias("verdict"))


@query("ag2_mode_first_seen", """WITH x AS (SELECT DISTINCT id, lower(trim(surface_text)) AS alias, upper(trim(normalized_target)) AS target FROM xrefs WHERE surface_text IS NOT NULL AND normalized_target IS NOT NULL),
c AS (SELECT alias, target, count(*) AS n, min(id) AS f FROM x GROUP BY 1, 2) SELECT alias, min_by(target, (-n, f, target)) AS target, sum(n)::BIGINT AS votes FROM c GROUP BY alias""")
def ag2(spark, d):
    rows = once(spark, d, "xrefs", "id", "surface_text", "normalized_target").where("surface_text IS NOT NULL AND normalized_target IS NOT NULL")
    return votes.mode(rows.select("id", F.lower(F.trim("surface_text")).alias("alias"), F.upper(F.trim("normalized_target")).alias("t")), ["alias"], "t", F.col("id"), "target")


@query("ag3_unambiguous_section", f"WITH {VA} SELECT volume || ' ' || section_name AS section, min(title) AS title FROM va WHERE section_name IS NOT NULL AND title IS NOT NULL GROUP BY 1 HAVING count(DISTINCT title) = 1")
def ag3(spark, d):
    """Sections of a volume that only one article has."""
    rows = valid(spark, d).select(F.concat_ws(" ", F.col("volume").cast("string"), F.col("section_name")).alias("section"), "title", "section_name", "volume")
    return votes.unambiguous(rows.where("section_name IS NOT NULL AND volume IS NOT NULL"), "section", "title").select("section", "title")


@query("ag4_unique_titles", f"WITH {VA} SELECT regexp_replace(upper(strip_accents(title)), '[^A-Z0-9]+', '', 'g') AS k, min(id) AS id FROM va GROUP BY 1 HAVING count(DISTINCT id) = 1")
def ag4(spark, d):
    return votes.unambiguous(valid(spark, d).select(X.article_norm("title").alias("k"), "id"), "k", "id").select("k", "id")


@query("ag5_spelling_vote", f"WITH {VC}, c AS (SELECT {_NK.format('full_name')} AS k, full_name, count(*) AS n FROM vc GROUP BY 1, 2) SELECT k, max_by(full_name, (n, length(full_name), full_name)) AS spelling FROM c GROUP BY k")
def ag5(spark, d):
    counted = valid(spark, d, "contributors").groupBy(name_key("full_name").alias("k"), "full_name").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("k").agg(F.max_by("full_name", F.struct("n", F.length("full_name"), "full_name")).alias("spelling"))


@query("ag6_initials_mode", "WITH c AS (SELECT contributor_id, initials, count(*) AS n FROM (SELECT DISTINCT id, contributor_id, initials FROM contributor_initials WHERE initials IS NOT NULL) GROUP BY 1, 2) SELECT contributor_id, max_by(initials, (n, -length(initials), initials)) AS initials FROM c GROUP BY 1")
def ag6(spark, d):
    counted = once(spark, d, "contributor_initials", "id", "contributor_id", "initials").where("initials IS NOT NULL").groupBy("contributor_id", "initials").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("contributor_id").agg(F.max_by("initials", F.struct("n", -F.length("initials"), "initials")).alias("initials"))


@query("ag7_kind_footprint", f"WITH {VA} SELECT c.contributor_id, coalesce(va.article_type, '-') AS kind, count(*) AS n FROM (SELECT DISTINCT id, article_id, contributor_id FROM article_contributors) c JOIN va ON va.id = c.article_id GROUP BY 1, 2")
def ag7(spark, d):
    kinds = valid(spark, d).select(F.col("id").alias("article_id"), F.coalesce("article_type", F.lit("-")).alias("kind"))
    return once(spark, d, "article_contributors", "id", "article_id", "contributor_id").join(kinds, "article_id").groupBy("contributor_id", "kind").agg(F.count(F.lit(1)).alias("n"))


_BIN = "CASE WHEN n < 100 THEN '0-99' WHEN n < 250 THEN '100-249' WHEN n < 500 THEN '250-499' WHEN n < 1000 THEN '500-999' WHEN n < 2500 THEN '1000-2499' WHEN n < 5000 THEN '2500-4999' WHEN n < 10000 THEN '5000-9999' ELSE '10000+' END"


@query("ag8_length_buckets", f"SELECT lang, {_BIN} AS bucket, count(*) AS n_docs FROM (SELECT lang, coalesce(length(text), 0) AS n FROM documents) GROUP BY 1, 2")
def ag8(spark, d):
    sized = table(spark, d, "documents").select("lang", F.coalesce(F.length("text"), F.lit(0)).alias("n"))
    return sized.groupBy("lang", F.expr(_BIN).alias("bucket")).agg(F.count(F.lit(1)).alias("n_docs"))


@query("ag8_quality_rollup", f"WITH {VA} SELECT volume, article_type, grouping(volume, article_type) AS level, count(*) AS n, sum(length(body))::BIGINT AS chars FROM va GROUP BY ROLLUP (volume, article_type)")
def ag8_rollup(spark, d):
    return valid(spark, d).rollup("volume", "article_type").agg(F.grouping_id().cast("bigint").alias("level"), F.count(F.lit(1)).alias("n"), F.sum(F.length("body")).alias("chars"))


@query("ag9_issue_counts", r"""WITH t AS (SELECT 'raw_text' AS consumer, id, raw_text AS t FROM source_pages UNION ALL SELECT 'wikitext', id, wikitext FROM source_pages), f AS (SELECT consumer, id, 'attr' AS category FROM t WHERE regexp_matches(t, '\b(style|align|valign|colspan|rowspan|bgcolor|scope|cellpadding|cellspacing|width|height)=')
UNION ALL SELECT consumer, id, 'marker' FROM t WHERE regexp_matches(t, '«/?[A-Z]\w*(\[|:|»)') UNION ALL SELECT consumer, id, 'sentinel' FROM t WHERE contains(t, chr(1)) OR contains(t, chr(2)) OR contains(t, chr(3)) UNION ALL SELECT consumer, id, 'template' FROM t WHERE contains(t, '{{') OR contains(t, '}}')
UNION ALL SELECT consumer, id, 'wikilink' FROM t WHERE contains(t, '[[') OR contains(t, ']]')) SELECT consumer, category, count(DISTINCT id) AS n FROM f GROUP BY 1, 2""")
def ag9(spark, d):
    """Pages with each kind of leak, by the text that has it."""
    found = [F.struct(F.lit(c).alias("consumer"), find_leaks(F.col(c), "text").alias("leaks")) for c in ("raw_text", "wikitext")]
    leaks = table(spark, d, "source_pages").select("id", F.explode(F.array(*found)).alias("f")).select("id", "f.consumer", F.explode("f.leaks").alias("category"))
    return leaks.distinct().groupBy("consumer", "category").agg(F.count(F.lit(1)).alias("n"))


@query("ag10_level_histogram", "SELECT volume, count(*) FILTER (level = 0) AS blank, count(*) FILTER (level = 1) AS raw_only, count(*) FILTER (level = 2) AS transcribed, min(level) AS lowest FROM (SELECT DISTINCT id, volume, CASE WHEN trim(coalesce(raw_text, ''), chr(10) || ' ') = '' THEN 0 WHEN wikitext IS NULL THEN 1 ELSE 2 END AS level FROM source_pages) GROUP BY volume")
def ag10(spark, d):
    level = F.when(F.trim(F.coalesce("raw_text", F.lit("")), F.lit("\n ")) == "", 0).when(F.col("wikitext").isNull(), 1).otherwise(2)
    rows = table(spark, d, "source_pages").select("id", "volume", level.alias("level")).distinct()
    return rows.groupBy("volume").agg(*[F.count_if(F.col("level") == i).alias(n) for i, n in enumerate(("blank", "raw_only", "transcribed"))], F.min("level").alias("lowest"))


@query("ag11_roster", "WITH a AS (SELECT DISTINCT article_id, contributor_id FROM article_contributors WHERE article_id IS NOT NULL), i AS (SELECT contributor_id, min(initials) AS initials FROM contributor_initials GROUP BY 1) SELECT coalesce(i.initials, '?') AS signature, count(*) AS n_articles, min(article_id) AS first_article FROM a LEFT JOIN i USING (contributor_id) GROUP BY 1")
def ag11(spark, d):
    signed = table(spark, d, "article_contributors").where("article_id IS NOT NULL").select("article_id", "contributor_id").distinct()
    initials = table(spark, d, "contributor_initials").groupBy("contributor_id").agg(F.min("initials").alias("initials"))
    return signed.join(initials, "contributor_id", "left").groupBy(F.coalesce("initials", F.lit("?")).alias("signature")).agg(F.count(F.lit(1)).alias("n_articles"), F.min("article_id").alias("first_article"))


@query("ag12_comma_fraction", "SELECT category, round(avg(CASE WHEN contains(heading, ',') THEN 1.0 ELSE 0.0 END), 6) AS share, avg(CASE WHEN contains(heading, ',') THEN 1.0 ELSE 0.0 END) >= 0.70 AS personal FROM headings GROUP BY 1")
def ag12(spark, d):
    share = F.avg(F.col("heading").contains(",").cast("double"))
    return table(spark, d, "headings").groupBy("category").agg(F.round(share, 6).alias("share"), (share >= 0.70).alias("personal"))


@query("ag13_structure_signatures", "SELECT signature, count(*) AS n, min(doc_id) AS example FROM (SELECT doc_id, (CASE WHEN contains(text, '«B»') THEN 'B' ELSE '' END) || (CASE WHEN contains(text, chr(10) || chr(10)) THEN 'P' ELSE '' END) || (CASE WHEN contains(text, '|') THEN 'T' ELSE '' END) || (CASE WHEN contains(text, 'Fig.') THEN 'F' ELSE '' END) AS signature FROM documents WHERE text IS NOT NULL) GROUP BY 1")
def ag13(spark, d):
    flags = [F.when(F.col("text").contains(part), letter).otherwise("") for part, letter in (("«B»", "B"), ("\n\n", "P"), ("|", "T"), ("Fig.", "F"))]
    return table(spark, d, "documents").where("text IS NOT NULL").groupBy(F.concat(*flags).alias("signature")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("example"))


@query("ag14_label_histogram", f"WITH {VA} SELECT label, count(*) AS n, count(DISTINCT id) AS n_articles FROM (SELECT id, unnest(regexp_extract_all(body, '«([A-Z][A-Za-z0-9_]*)(\\[[^«»]*\\])?(:|»)', 1)) AS label FROM va) GROUP BY 1")
def ag14(spark, d):
    labels = valid(spark, d).select("id", F.explode(F.regexp_extract_all("body", F.lit(r"«([A-Z][A-Za-z0-9_]*)(\[[^«»]*\])?(:|»)"), F.lit(1))).alias("label"))
    per = labels.groupBy("label", "id").agg(F.count(F.lit(1)).alias("k"))
    return per.groupBy("label").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("n_articles"))


@query("ag15_resolution_rate", "SELECT xref_type, count(*) AS n, count(*) FILTER (status = 'resolved') AS resolved, round(count(*) FILTER (status = 'resolved') / count(*), 6) AS rate FROM (SELECT DISTINCT id, xref_type, status FROM xrefs) GROUP BY 1")
def ag15(spark, d):
    hit = F.count_if(F.col("status") == "resolved")
    return once(spark, d, "xrefs", "id", "xref_type", "status").groupBy("xref_type").agg(F.count(F.lit(1)).alias("n"), hit.alias("resolved"), F.round(hit / F.count(F.lit(1)), 6).alias("rate"))


@query("ag16_fingerprint", f"WITH {VA}, l AS (SELECT id || chr(9) || length(body) || chr(9) || sha256(body) AS line FROM va), b AS (SELECT substr(md5(line), 1, 3) AS bucket, sha256(string_agg(line, chr(10) ORDER BY line)) AS h, count(*) AS n FROM l WHERE line IS NOT NULL GROUP BY 1) SELECT sha256(string_agg(h, chr(10) ORDER BY bucket)) AS fingerprint, sum(n)::BIGINT AS n_lines FROM b")
def ag16(spark, d):
    return votes.merkle(valid(spark, d), F.concat(F.col("id").cast("string"), F.lit("\t"), F.length("body").cast("string"), F.lit("\t"), F.sha2("body", 256)))


@query("ag17_kind_union", f"WITH {VA} SELECT upper(title) AS title, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds FROM (SELECT title, coalesce(article_type, '-') AS kind FROM va UNION ALL SELECT heading, category FROM headings) GROUP BY 1")
def ag17(spark, d):
    rows = valid(spark, d).select("title", F.coalesce("article_type", F.lit("-")).alias("kind")).unionByName(table(spark, d, "headings").select(F.col("heading").alias("title"), F.col("category").alias("kind")))
    return rows.select(F.upper("title").alias("title"), "kind").distinct().groupBy("title").agg(F.array_join(F.array_sort(F.collect_list("kind")), ",").alias("kinds"))


@query("ag18_canonical_pick", f"WITH {VC}, n AS (SELECT contributor_id, count(DISTINCT article_id) AS n FROM article_contributors GROUP BY 1) SELECT {_NK.format('full_name')} AS k, max_by(vc.id, (coalesce(n.n, 0), length(coalesce(description, '')), length(full_name), -vc.id)) AS canonical, count(*) AS n_records FROM vc LEFT JOIN n ON n.contributor_id = vc.id GROUP BY 1")
def ag18(spark, d):
    written = table(spark, d, "article_contributors").select("contributor_id", "article_id").distinct().groupBy(F.col("contributor_id").alias("id")).agg(F.count("article_id").alias("n"))
    rows = valid(spark, d, "contributors").join(written, "id", "left")
    order = F.struct(F.coalesce("n", F.lit(0)), F.length(F.coalesce("description", F.lit(""))), F.length("full_name"), -F.col("id"))
    return rows.groupBy(name_key("full_name").alias("k")).agg(F.max_by("id", order).alias("canonical"), F.count(F.lit(1)).alias("n_records"))


@query("ag19_jaccard", """WITH a AS (SELECT DISTINCT contributor_id AS c, article_id AS x FROM article_contributors WHERE contributor_id IS NOT NULL AND article_id IS NOT NULL), n AS (SELECT c, count(*) AS n FROM a GROUP BY 1),
m AS (SELECT p.c AS c1, q.c AS c2, count(*) AS k FROM a p JOIN a q ON p.x = q.x AND p.c < q.c GROUP BY 1, 2) SELECT c1, c2, k AS shared, round(k / (n1.n + n2.n - k), 6) AS jaccard FROM m JOIN n n1 ON n1.c = c1 JOIN n n2 ON n2.c = c2 WHERE k >= 2""")
def ag19(spark, d):
    a = table(spark, d, "article_contributors").where("contributor_id IS NOT NULL AND article_id IS NOT NULL").select(F.col("contributor_id").alias("c"), F.col("article_id").alias("x")).distinct()
    sizes = a.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    met = a.withColumnRenamed("c", "c1").join(a.withColumnRenamed("c", "c2"), "x").where("c1 < c2").groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("shared")).where("shared >= 2")
    sized = met.join(sizes.select(F.col("c").alias("c1"), F.col("n").alias("n1")), "c1").join(sizes.select(F.col("c").alias("c2"), F.col("n").alias("n2")), "c2")
    return sized.select("c1", "c2", "shared", F.round(F.col("shared") / (F.col("n1") + F.col("n2") - F.col("shared")), 6).alias("jaccard"))


@query("ag20_link_census", "WITH r AS (SELECT id, min_by(body, loaded_at) AS a, max_by(body, loaded_at) AS b FROM articles GROUP BY id) SELECT id, len(regexp_extract_all(a, '«LN:')) AS before, len(regexp_extract_all(b, '«LN:')) AS after, len(regexp_extract_all(b, '«LN:')) - len(regexp_extract_all(a, '«LN:')) AS change FROM r")
def ag20(spark, d):
    def links(c):
        return F.size(F.regexp_extract_all(c, F.lit("«LN:"), F.lit(0))).cast("bigint")

    ends = table(spark, d, "articles").groupBy("id").agg(F.min_by(links("body"), F.col("loaded_at")).alias("before"), F.max_by(links("body"), F.col("loaded_at")).alias("after"))
    return ends.withColumn("change", F.col("after") - F.col("before"))


@query("ag21_quality_gate", f"WITH {VA}, m AS (SELECT 'articles' AS metric, count(*)::DOUBLE AS value FROM va UNION ALL SELECT 'resolved', count(*) FILTER (status = 'resolved') FROM xrefs UNION ALL SELECT 'blank_bodies', count(*) FROM va WHERE trim(body) = ''), t AS (SELECT * FROM (VALUES ('articles', 1.0, NULL), ('resolved', 1.0, NULL), ('blank_bodies', NULL, 100000.0), ('plates', 1.0, NULL)) AS v(metric, least, most)) SELECT t.metric, m.value, CASE WHEN m.value IS NULL THEN 'absent' WHEN m.value < t.least OR m.value > t.most THEN 'fail' ELSE 'pass' END AS status FROM t LEFT JOIN m USING (metric)")
def ag21(spark, d):
    live = valid(spark, d).agg(F.count(F.lit(1)).cast("double").alias("articles"), F.count_if(F.trim("body") == "").cast("double").alias("blank_bodies"))
    refs = table(spark, d, "xrefs").agg(F.count_if(F.col("status") == "resolved").cast("double").alias("resolved"))
    metrics = live.unpivot([], ["articles", "blank_bodies"], "metric", "value").unionByName(refs.unpivot([], ["resolved"], "metric", "value"))
    limits = spark.createDataFrame([("articles", 1.0, None), ("resolved", 1.0, None), ("blank_bodies", None, 100000.0), ("plates", 1.0, None)], "metric string, least double, most double")
    bad = (F.col("value") < F.col("least")) | (F.col("value") > F.col("most"))
    return limits.join(metrics, "metric", "left").select("metric", "value", F.when(F.col("value").isNull(), "absent").when(bad, "fail").otherwise("pass").alias("status"))


@query("ag23_duplicate_groups", "SELECT sha256(text) AS h, count(*) AS n, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def ag23(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").groupBy(F.sha2("text", 256).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


# --- windows -----------------------------------------------------------------------------------


@query("wn1_page_offsets", "SELECT id, volume, coalesce(sum(length(coalesce(raw_text, '')) + 1) OVER (PARTITION BY volume ORDER BY page_number, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at FROM (SELECT DISTINCT id, volume, page_number, raw_text FROM source_pages)")
def wn1(spark, d):
    pages = once(spark, d, "source_pages", "id", "volume", "page_number", "raw_text").select("id", "volume", "page_number", (F.length(F.coalesce("raw_text", F.lit(""))) + 1).cast("bigint").alias("size"))
    return running_sum(pages, ["volume"], ["page_number", "id"], "size", "at").select("id", "volume", "at")


@query("wn2_slices", f"WITH {VA}, s AS (SELECT volume, page_start, min(id) AS id FROM va GROUP BY 1, 2), m AS (SELECT volume, max(page_number) AS last FROM source_pages GROUP BY 1) SELECT s.id, s.volume, s.page_start, coalesce(lead(s.page_start) OVER (PARTITION BY s.volume ORDER BY s.page_start), m.last) AS until_page FROM s JOIN m USING (volume)")
def wn2(spark, d):
    starts = valid(spark, d).groupBy("volume", "page_start").agg(F.min("id").alias("id"))
    ends = table(spark, d, "source_pages").groupBy("volume").agg(F.max("page_number").alias("last"))
    return sequence.slices(starts.join(ends, "volume"), ["volume"], "page_start", F.col("last"), "until_page").select("id", "volume", "page_start", "until_page")


@query("wn3_first_at_place", f"WITH {VA} SELECT volume, page_start, min_by(title, (page_end, title, id)) AS title FROM va GROUP BY 1, 2")
def wn3(spark, d):
    rows = valid(spark, d).select("volume", "page_start", "page_end", "title", "id")
    return first_wins(rows, ["volume", "page_start"], ["page_end", "title", "id"]).select("volume", "page_start", "title")


_U = "u AS (SELECT heading_id, heading, substr(sha1(heading), 1, 2) AS base, substr(sha1(lower(strip_accents(heading))), 3, 2) AS other FROM headings)"


@query("wn4_unique_ids", f"""WITH {_U}, r AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY heading, heading_id) AS place FROM u), f AS (SELECT *, row_number() OVER (PARTITION BY other ORDER BY heading, heading_id) AS claim FROM r WHERE place > 1 AND other NOT IN (SELECT base FROM u)),
x AS (SELECT * FROM r WHERE place > 1 AND heading_id NOT IN (SELECT heading_id FROM f WHERE claim = 1))
SELECT heading_id, base AS made FROM r WHERE place = 1 UNION ALL SELECT heading_id, other FROM f WHERE claim = 1 UNION ALL SELECT heading_id, base || '-' || (row_number() OVER (PARTITION BY base ORDER BY heading, heading_id) + 1) FROM x""")
def wn4(spark, d):
    rows = table(spark, d, "headings").select("heading_id", "heading", F.substring(F.sha1("heading"), 1, 2).alias("base"), F.substring(F.sha1(F.lower(X.fold_accents("heading"))), 3, 2).alias("other"))
    return sequence.unique_ids(rows, "base", "other", ["heading", "heading_id"], "made").select("heading_id", "made")


_READ = "p AS (SELECT DISTINCT id, volume, page_number, TRY_CAST(regexp_extract(raw_text, '(?m)^[\\[\\s]*(\\d{1,3})\\b', 1) AS INT) AS printed FROM source_pages), o AS (SELECT id, volume, page_number, printed, page_number - printed AS off FROM p WHERE printed IS NOT NULL)"


def _readings(spark, d):
    printed = F.regexp_extract("raw_text", r"(?m)^[\[\s]*(\d{1,3})\b", 1)
    rows = table(spark, d, "source_pages").where(printed != "").select("id", "volume", "page_number", printed.cast("int").alias("printed")).distinct()
    return rows.withColumn("off", F.col("page_number") - F.col("printed")).withColumn("at", F.col("page_number").cast("bigint") * 100_000_000_000 + F.col("id"))


@query("wn5_outliers", f"WITH {_READ} SELECT id, coalesce(abs(off - lag(off, 1) OVER w) <= 2, FALSE) OR coalesce(abs(off - lag(off, 2) OVER w) <= 2, FALSE) OR coalesce(abs(off - lead(off, 1) OVER w) <= 2, FALSE) OR coalesce(abs(off - lead(off, 2) OVER w) <= 2, FALSE) AS kept FROM o WINDOW w AS (PARTITION BY volume ORDER BY page_number, id)")
def wn5(spark, d):
    return sequence.plausible(_readings(spark, d), ["volume"], "at", "off").select("id", "kept")


@query("wn6_runs", f"WITH {_READ}, g AS (SELECT *, CASE WHEN off IS NOT DISTINCT FROM lag(off) OVER (PARTITION BY volume ORDER BY page_number, id) AND row_number() OVER (PARTITION BY volume ORDER BY page_number, id) > 1 THEN 0 ELSE 1 END AS n FROM o), i AS (SELECT *, sum(n) OVER (PARTITION BY volume ORDER BY page_number, id ROWS UNBOUNDED PRECEDING) AS island FROM g) SELECT volume, island::BIGINT AS island, min(off) AS off, count(*) AS n_pages FROM i GROUP BY 1, 2")
def wn6(spark, d):
    runs = sequence.islands(_readings(spark, d), ["volume"], "at", "off")
    return runs.groupBy("volume", "island").agg(F.min("off").alias("off"), F.count(F.lit(1)).alias("n_pages"))


#: The readings of each volume in order, for walks by recursion.
_WALK = f"WITH RECURSIVE {_READ}, s AS (SELECT *, row_number() OVER (PARTITION BY volume ORDER BY page_number, id) AS i, lead(off) OVER (PARTITION BY volume ORDER BY page_number, id) AS following FROM o)"


@query("wn7_rising", f"""{_WALK}, q AS (SELECT a.volume, a.i, any_value(a.id) AS id, any_value(a.printed) AS printed, 2 * count(*) FILTER (b.printed >= a.printed) >= count(b.i) AS fine FROM s a LEFT JOIN s b ON b.volume = a.volume AND b.i > a.i GROUP BY 1, 2),
w AS (SELECT volume, i, id, printed, fine AS kept, CASE WHEN fine THEN printed ELSE -1 END AS last FROM q WHERE i = 1 UNION ALL SELECT q.volume, q.i, q.id, q.printed, q.fine AND q.printed > w.last, CASE WHEN q.fine AND q.printed > w.last THEN q.printed ELSE w.last END FROM w JOIN q ON q.volume = w.volume AND q.i = w.i + 1) SELECT id, printed, kept FROM w""")
def wn7(spark, d):
    rows = _readings(spark, d).select("volume", "id", "at", "printed")
    return sequence.rising(rows, "volume", "at", "printed", "volume int, id bigint, at bigint, printed int, kept boolean").select("id", "printed", "kept")


@query("wn8_gap_fill", f"""WITH {_READ}, a AS (SELECT volume, page_number, min(printed) AS printed FROM o GROUP BY 1, 2 HAVING min(printed) = max(printed)), s AS (SELECT *, coalesce(lead(page_number) OVER w - 1, page_number) AS upto, lead(printed) OVER w AS nxt FROM a WINDOW w AS (PARTITION BY volume ORDER BY page_number)), e AS (SELECT volume, unnest(generate_series(page_number, upto)) AS place, page_number, printed, nxt FROM s)
SELECT volume, CAST(place AS INT) AS page_number, CASE WHEN nxt IS NULL OR printed + place - page_number < nxt THEN CAST(printed + place - page_number AS INT) END AS printed FROM e""")
def wn8(spark, d):
    return sequence.fill_gaps(_readings(spark, d), ["volume"], "page_number", "printed")


@query("wn9_plus_one_pins", f"""{_WALK}, w AS (SELECT volume, i, id, coalesce(off = following, FALSE) AS kept, CASE WHEN off = following THEN off END AS current FROM s WHERE i = 1
UNION ALL SELECT s.volume, s.i, s.id, CASE WHEN w.current IS NULL THEN coalesce(s.off = s.following, FALSE) ELSE s.off - w.current BETWEEN 0 AND 1 END, CASE WHEN (w.current IS NULL AND s.off = s.following) OR s.off - w.current BETWEEN 0 AND 1 THEN s.off ELSE w.current END FROM w JOIN s ON s.volume = w.volume AND s.i = w.i + 1) SELECT id, kept FROM w""")
def wn9(spark, d):
    """Readings that continue the walk of one printed page to a page, by volume."""
    rows = _readings(spark, d).select("volume", "id", "at", "off")

    def pins(frame):
        frame = frame.sort_values("at", kind="stable")
        kept, current = [], None
        values = frame["off"].tolist()
        for i, v in enumerate(values):
            fine = current is None and values[i + 1 : i + 2] == [v] or current is not None and 0 <= v - current <= 1
            kept.append(bool(fine))
            current = v if fine else current
        return frame.assign(kept=kept)

    return rows.groupBy("volume").applyInPandas(pins, "volume int, id bigint, at bigint, off int, kept boolean").select("id", "kept")


@query("wn10_first_article_page", f"WITH {_READ}, f AS (SELECT volume, min(page_number) AS first_read, min_by(printed, page_number) AS printed FROM o GROUP BY 1), n AS (SELECT volume, page_number, row_number() OVER (PARTITION BY volume ORDER BY page_number) AS rn FROM (SELECT DISTINCT volume, page_number FROM source_pages)) SELECT f.volume, n2.page_number AS first_page FROM f JOIN n n1 ON n1.volume = f.volume AND n1.page_number = f.first_read JOIN n n2 ON n2.volume = f.volume AND n2.rn = greatest(1, n1.rn - (f.printed - 1))")
def wn10(spark, d):
    first = _readings(spark, d).groupBy("volume").agg(F.min("page_number").alias("page_number"), F.min_by("printed", "page_number").alias("printed"))
    pages = once(spark, d, "source_pages", "volume", "page_number")
    ranked = pages.withColumn("rn", F.row_number().over(Window.partitionBy("volume").orderBy("page_number")))
    back = first.join(ranked, ["volume", "page_number"]).select("volume", F.greatest(F.lit(1), F.col("rn") - (F.col("printed") - 1)).alias("rn"))
    return back.join(ranked, ["volume", "rn"]).select("volume", F.col("page_number").alias("first_page"))


@query("wn11_place_pages")
def wn11(spark, d):
    """Where the pages of an article begin in its letters, by their expected places."""
    letters = F.regexp_replace(F.lower(X.plain_text("body")), "[^a-z]", "")
    bodies = valid(spark, d).select(F.col("id").alias("article_id"), letters.alias("letters"))
    keys = once(spark, d, "article_segments", "article_id", "body_offset").groupBy("article_id").agg(F.array_sort(F.collect_set("body_offset")).alias("expected"))
    rows = bodies.join(keys, "article_id")

    return rows.select("article_id", F.size("expected").alias("n_pages"), _placed(rows).alias("places"))


def _placed(rows):
    @F.pandas_udf("array<int>")
    def places(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for text, expected in zip(texts, lists):
            expected = [int(e) for e in expected]
            signs = [text[e : e + 12] for e in expected]
            out.append(sequence.clamp(sequence.locate(text, signs, expected), expected, len(text)))
        return pd.Series(out, dtype=object)

    return places(F.col("letters"), F.col("expected"))


@query("wn12_clamped", "WITH s AS (SELECT DISTINCT article_id, sequence_in_article AS k, body_offset AS o FROM article_segments), f AS (SELECT *, CASE WHEN k % 2 = 1 THEN o END AS found FROM s), c AS (SELECT *, last_value(found IGNORE NULLS) OVER (PARTITION BY article_id ORDER BY k, o ROWS UNBOUNDED PRECEDING) AS lo, first_value(found IGNORE NULLS) OVER (PARTITION BY article_id ORDER BY k, o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi FROM f) SELECT article_id, k, o, least(greatest(o, coalesce(lo, 0)), coalesce(hi, 2147483647)) AS place FROM c")
def wn12(spark, d):
    rows = table(spark, d, "article_segments").select("article_id", F.col("sequence_in_article").alias("k"), F.col("body_offset").alias("o")).distinct()
    rows = rows.withColumn("found", F.when(F.col("k") % 2 == 1, F.col("o")))
    by = Window.partitionBy("article_id").orderBy("k", "o")
    low = F.last("found", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))
    high = F.first("found", ignorenulls=True).over(by.rowsBetween(0, Window.unboundedFollowing))
    return rows.select("article_id", "k", "o", F.least(F.greatest("o", F.coalesce(low, F.lit(0))), F.coalesce(high, F.lit(2147483647))).alias("place"))


@query("wn13_contributor_order", "WITH f AS (SELECT article_id, contributor_id, min(seq_no) AS first_seq FROM article_contributors WHERE article_id IS NOT NULL AND contributor_id IS NOT NULL GROUP BY 1, 2) SELECT article_id, contributor_id, row_number() OVER (PARTITION BY article_id ORDER BY first_seq, contributor_id) AS place FROM f")
def wn13(spark, d):
    first = table(spark, d, "article_contributors").where("article_id IS NOT NULL AND contributor_id IS NOT NULL").groupBy("article_id", "contributor_id").agg(F.min("seq_no").alias("s"))
    return first.select("article_id", "contributor_id", F.row_number().over(Window.partitionBy("article_id").orderBy("s", "contributor_id")).alias("place"))


@query("wn14_dedupe_ids", "WITH x AS (SELECT DISTINCT id, article_id, lower(trim(coalesce(normalized_target, 'x'))) AS name FROM xrefs) SELECT id, CASE WHEN row_number() OVER w = 1 THEN name ELSE name || '-' || row_number() OVER w END AS anchor FROM x WINDOW w AS (PARTITION BY article_id, name ORDER BY id)")
def wn14(spark, d):
    rows = table(spark, d, "xrefs").select("id", "article_id", F.lower(F.trim(F.coalesce("normalized_target", F.lit("x")))).alias("name")).distinct()
    return sequence.repeat_suffix(rows, ["article_id"], "name", ["id"], "anchor").select("id", "anchor")


@query("wn15_note_numbers", "WITH x AS (SELECT DISTINCT id, article_id, coalesce(target_section, '-') AS name FROM xrefs), f AS (SELECT article_id, name, row_number() OVER (PARTITION BY article_id ORDER BY min(id), name) AS number FROM x GROUP BY 1, 2) SELECT x.id, f.number FROM x JOIN f USING (article_id, name)")
def wn15(spark, d):
    rows = table(spark, d, "xrefs").where("article_id IS NOT NULL").select("id", "article_id", F.coalesce("target_section", F.lit("-")).alias("name")).distinct()
    return sequence.first_met_number(rows, ["article_id"], "name", "id", "number").select("id", "number")


@query("wn17_known_order", "WITH RECURSIVE s AS (SELECT category AS part, heading, substr(heading, 1, 1) AS letter, row_number() OVER (PARTITION BY category ORDER BY heading) AS i FROM headings), w AS (SELECT part, heading, i, CASE WHEN letter = 'A' THEN 0 ELSE -1 END AS category FROM s WHERE i = 1 UNION ALL SELECT s.part, s.heading, s.i, CASE WHEN s.letter = chr(66 + w.category) THEN w.category + 1 ELSE w.category END FROM w JOIN s ON s.part = w.part AND s.i = w.i + 1) SELECT part, heading, category FROM w")
def wn17(spark, d):
    """The letter that each heading's volume order has reached, advancing one letter at a time."""
    rows = table(spark, d, "headings").select("category", "heading", F.substring("heading", 1, 1).alias("letter"))
    openers = [[c] for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    return sequence.known_order(rows.withColumnRenamed("category", "part"), "part", "heading", "letter", openers, "part string, heading string, letter string, category int").select("part", "heading", "category")


@F.pandas_udf(rows("row:int, col:int, cell:string"))
def _grids(texts: pd.Series) -> pd.Series:
    """The columns of figures of a page as the cells of a table, in which a figure that stands under its like is the same cell going down, spread out again."""
    out = []
    for text in texts:
        lines = [(i, re.split(r"\s{2,}", x.strip())) for i, x in enumerate((text or "").split("\n")) if re.match(r"^\d+\s{2,}\d+\s{2,}\d+$", x)]
        cells: list[list[list]] = []
        above: list[list] = []  # for each column the cell that goes on
        for _, figures in lines:
            row = []
            for col, figure in enumerate(figures):
                if col < len(above) and above[col][0] == figure:
                    above[col][1] += 1
                    continue
                cell = [figure, 1, 1]
                row.append(cell)
                above[col : col + 1] = [cell]
            cells.append(row)
        grid = sequence.spread_cells([[tuple(c) for c in row] for row in cells])
        out.append([{"row": i, "col": j, "cell": c} for (i, _), row in zip(lines, grid) for j, c in enumerate(row)])
    return pd.Series(out, dtype=object)


@query("wn18_table_grid", r"""WITH l AS (SELECT id, unnest(range(0, len(s))) AS row, unnest(s) AS line FROM (SELECT DISTINCT id, string_split(raw_text, chr(10)) AS s FROM source_pages)), c AS (SELECT id, row, regexp_split_to_array(trim(line), '\s{2,}') AS c FROM l WHERE regexp_matches(line, '^\d+\s{2,}\d+\s{2,}\d+$'))
SELECT id, CAST(row AS INT) AS row, CAST(unnest(range(0, len(c))) AS INT) AS col, unnest(c) AS cell FROM c""")
def wn18(spark, d):
    """The tabular lines of the pages as cells of a full grid."""
    return once(spark, d, "source_pages", "id", "raw_text").select("id", F.explode(_grids("raw_text")).alias("c")).select("id", "c.row", "c.col", "c.cell")


# --- sorts -------------------------------------------------------------------------------------


@query("so1_total_order", f"WITH {VA} SELECT id, row_number() OVER (ORDER BY volume, page_start, page_end, title, id) AS place FROM va")
def so1(spark, d):
    rows = valid(spark, d).select("id", "volume", "page_start", "page_end", "title")
    ordered = running_sum(rows.withColumn("one", F.lit(1)).withColumn("all", F.lit(0)), ["all"], ["volume", "page_start", "page_end", "title", "id"], "one", "before")
    return ordered.select("id", (F.col("before") + 1).cast("bigint").alias("place"))


@query("so3_top_longest", f"WITH {VA} SELECT id, length(body) AS chars FROM va ORDER BY length(body) DESC, id LIMIT 20")
def so3(spark, d):
    return valid(spark, d).select("id", F.length("body").alias("chars")).orderBy(F.desc("chars"), "id").limit(20)


@query("so4_systematic_sample", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) WHERE (rn - 1) % 50 = 0")
def so4(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.lit(1).alias("one"), F.lit(0).alias("all"))
    return running_sum(rows, ["all"], ["doc_id"], "one", "before").where("before % 50 = 0").select("doc_id")


@query("so5_margin_pick", "WITH s AS (SELECT a.vec_id AS q, b.vec_id AS c, round(list_dot_product(a.embedding, b.embedding) / (sqrt(list_dot_product(a.embedding, a.embedding)) * sqrt(list_dot_product(b.embedding, b.embedding))), 4) AS cosine FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY cosine DESC, c) AS k FROM s) SELECT q, max(CASE WHEN k = 1 THEN c END) AS best, max(CASE WHEN k = 1 THEN cosine END) AS cosine, max(CASE WHEN k = 1 THEN cosine END) - max(CASE WHEN k = 2 THEN cosine END) >= 0.05 AS clear FROM r WHERE k <= 2 GROUP BY q")
def so5(spark, d):
    from lexiloom.functions.vectors import cosine

    v = table(spark, d, "embeddings")
    q = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("e1"), "label")
    c = v.select(F.col("vec_id").alias("c"), F.col("embedding").alias("e2"), "label")
    scored = q.join(c, "label").where("q <> c").select("q", "c", F.round(cosine("e1", "e2"), 4).alias("cosine"))
    top = scored.withColumn("k", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("cosine"), "c"))).where("k <= 2")
    best = top.groupBy("q").agg(F.max(F.when(F.col("k") == 1, F.col("c"))).alias("best"), F.max(F.when(F.col("k") == 1, F.col("cosine"))).alias("cosine"), F.max(F.when(F.col("k") == 2, F.col("cosine"))).alias("second"))
    return best.select("q", "best", "cosine", (F.col("cosine") - F.col("second") >= 0.05).alias("clear"))


@query("so6_best_specific", "SELECT category, max_by(heading, (len(string_split(heading, ' ')), -length(heading), heading)) AS heading FROM headings GROUP BY 1")
def so6(spark, d):
    return table(spark, d, "headings").groupBy("category").agg(F.max_by("heading", F.struct(F.size(F.split("heading", " ")), -F.length("heading"), "heading")).alias("heading"))


@query("so7_collation", f"WITH {VA} SELECT id, lower(strip_accents(title)) AS sort_key FROM va")
def so7(spark, d):
    return valid(spark, d).select("id", F.lower(X.fold_accents("title")).alias("sort_key"))


@query("so9_principals_first", "SELECT id, row_number() OVER (PARTITION BY page ORDER BY CASE WHEN len(articles) >= 4 THEN 0 ELSE 1 END, CASE WHEN len(articles) >= 4 THEN id ELSE 0 END, lower(strip_accents(display)), id) AS place FROM (SELECT DISTINCT id, page, display, articles FROM vol29_entries)")
def so9(spark, d):
    rows = table(spark, d, "vol29_entries").select("id", "page", "display", F.size("articles").alias("n")).distinct()
    order = [F.when(F.col("n") >= 4, 0).otherwise(1), F.when(F.col("n") >= 4, F.col("id")).otherwise(0), F.lower(X.fold_accents("display")), F.col("id")]
    return rows.select("id", F.row_number().over(Window.partitionBy("page").orderBy(*order)).alias("place"))


# --- set operations ----------------------------------------------------------------------------


@query("se1_block_starts", f"""WITH {VA}, p AS (SELECT id, string_split(body, chr(10) || chr(10)) AS s FROM va WHERE body IS NOT NULL), b AS (SELECT id, unnest(range(1, len(s) + 1)) AS i, length(unnest(s)) + 2 AS n FROM p), o AS (SELECT id, coalesce(sum(n) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "at" FROM b) SELECT id, "at" FROM o UNION SELECT s.article_id, s.body_offset FROM article_segments s JOIN p ON p.id = s.article_id""")
def se1(spark, d):
    """Where blocks begin in the valid bodies: at 0, after each blank line, and where a page begins."""
    bodies = valid(spark, d).where("body IS NOT NULL").select("id", "body")
    sizes = F.transform(F.split("body", "\n\n"), lambda p: F.length(p) + 2)
    starts = F.transform(sizes, lambda n, i: F.aggregate(F.slice(sizes, 1, i), F.lit(0), lambda at, x: at + x).cast("bigint"))
    keys = table(spark, d, "article_segments").select(F.col("article_id").alias("id"), F.col("body_offset").cast("bigint").alias("at"))
    return bodies.select("id", F.explode(starts).alias("at")).unionByName(keys.join(bodies.select("id"), "id", "left_semi")).distinct()


_ALIAS = "al AS (SELECT upper(trim(surface_text)) AS alias, upper(trim(normalized_target)) AS target, 1 AS p FROM xrefs UNION ALL SELECT upper(split_part(heading, ',', 1)), heading, 2 FROM headings WHERE contains(heading, ',') UNION ALL SELECT upper(display), upper(full_name), 3 FROM vol29_entries)"


@query("se2_alias_overlay", f"WITH {_ALIAS}, b AS (SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY alias ORDER BY p DESC) AS r FROM al WHERE alias <> '' AND target <> '') WHERE r = 1) SELECT alias, min(target) AS target FROM b WHERE alias NOT IN (SELECT upper(title) FROM articles WHERE title IS NOT NULL) GROUP BY alias HAVING count(DISTINCT target) = 1")
def se2(spark, d):
    a = table(spark, d, "xrefs").select(F.upper(F.trim("surface_text")).alias("alias"), F.upper(F.trim("normalized_target")).alias("target"), F.lit(1).alias("p"))
    b = table(spark, d, "headings").where(F.col("heading").contains(",")).select(F.upper(F.substring_index("heading", ",", 1)).alias("alias"), F.col("heading").alias("target"), F.lit(2).alias("p"))
    c = table(spark, d, "vol29_entries").select(F.upper("display").alias("alias"), F.upper("full_name").alias("target"), F.lit(3).alias("p"))
    rows = a.unionByName(b).unionByName(c).where("alias <> '' AND target <> ''").distinct()
    last = rows.withColumn("r", F.dense_rank().over(Window.partitionBy("alias").orderBy(F.desc("p")))).where("r = 1")
    known = table(spark, d, "articles").where("title IS NOT NULL").select(F.upper("title").alias("alias")).distinct()
    return votes.unambiguous(last.join(known, "alias", "left_anti"), "alias", "target").select("alias", "target")


_TERMS = "t AS (SELECT doc_id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(strip_accents(text)), '[^a-z0-9]+'), lambda w: w <> ''))) AS term FROM documents)"


@query("se3_common_terms", f"WITH {_TERMS} SELECT doc_id FROM t WHERE term IN ('abbey', 'copper') GROUP BY 1 HAVING count(*) = 2")
def se3(spark, d):
    from lexiloom.operators.search import terms

    return terms(table(spark, d, "documents"), "doc_id", "text").where(F.col("term").isin("abbey", "copper")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select("doc_id")


@query("se4_except", "SELECT heading AS t, 'heading' AS side FROM headings EXCEPT SELECT title, 'heading' FROM articles UNION ALL SELECT * FROM (SELECT DISTINCT title, 'title' FROM articles WHERE title NOT IN (SELECT heading FROM headings))")
def se4(spark, d):
    h = table(spark, d, "headings").select(F.col("heading").alias("t"))
    a = table(spark, d, "articles").select(F.col("title").alias("t")).where("t IS NOT NULL")
    return h.subtract(a).withColumn("side", F.lit("heading")).unionByName(a.subtract(h).withColumn("side", F.lit("title")))


@query("se6_ordered_distinct", "SELECT article_id, string_agg(t, '|' ORDER BY f, t) AS targets FROM (SELECT article_id, upper(trim(normalized_target)) AS t, min(id) AS f FROM xrefs WHERE article_id IS NOT NULL AND normalized_target IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
def se6(spark, d):
    first = table(spark, d, "xrefs").where("article_id IS NOT NULL AND normalized_target IS NOT NULL").groupBy("article_id", F.upper(F.trim("normalized_target")).alias("t")).agg(F.min("id").alias("f"))
    return first.groupBy("article_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", "t"))), lambda s: s["t"]), "|").alias("targets"))


@query("se7_leaf_once", "SELECT page, article, min(id) AS entry_id FROM (SELECT page, id, unnest(articles) AS article FROM vol29_entries) GROUP BY 1, 2")
def se7(spark, d):
    return table(spark, d, "vol29_entries").select("page", "id", F.explode("articles").alias("article")).groupBy("page", "article").agg(F.min("id").alias("entry_id"))
