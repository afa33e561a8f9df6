"""Text functions over the corpus (scalar operators on strings, arrays and numbers)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lexiloom.functions import text as X
from lexiloom.tables import table

QUERIES: dict = {}
SQL: dict = {}
VALUE = re.compile(r"\$(?!\)?')")


def query(name: str, sql: str | None = None):
    """Register a query and its SQL."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def _titles(spark, d):
    return table(spark, d, "articles").select("title").where(F.col("title").isNotNull()).distinct()


def _over(name, source, column, expression, sql_expression, where="TRUE"):
    """A query that applies one expression to the distinct values of a column."""

    def run(spark, d, source=source, column=column, expression=expression):
        rows = table(spark, d, source).where(F.expr(where)).select(column).distinct()
        return rows.select(F.col(column).alias("given"), expression(F.col(column)).alias("made"))

    QUERIES[name] = run
    # a dollar sign stands for the value, except where it ends a pattern
    SQL[name] = f"SELECT given, {re.sub(VALUE, 'given', sql_expression)} AS made FROM (SELECT DISTINCT {column} AS given FROM {source} WHERE {where})"


_SPACES = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
_TRIM = "trim({}, ' ')"

_over("st1_accent_fold", "articles", "title", X.fold_accents, "strip_accents($)")
_over("st2_slug", "articles", "title", X.slug, "trim(regexp_replace(lower(trim($)), '[^a-z0-9]+', '-', 'g'), '-')")
_over("st3_digest", "articles", "body", X.digest, "substr(sha256($), 1, 16)")
_over("st4_strip_tags", "source_pages", "wikitext", lambda c: X.strip_tags(c, " "), "regexp_replace($, '<[^>]*>', ' ', 'g')")
_over(
    "st5_primary_headword", "articles", "title", X.primary_headword,
    "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace($, '\\s*(\\([^()]*\\)|\\[[^\\[\\]]*\\])', '', 'g'), '\\s*[(\\[].*$', '', 'g'), '(?i)\\bsurnamed\\b.*$', '', 'g'), ',.*$', '', 'g'), '\\s+', ' ', 'g'))",
)
_over("st6_unwrap", "source_pages", "wikitext", lambda c: X.bounded_stable(c, r"\{\{c\|([^{}|]*)\}\}", "$1"), "regexp_replace($, '\\{\\{c\\|([^{}|]*)\\}\\}', '\\1', 'g')")
_over("st7_collapse_key", "xrefs", "normalized_target", X.collapse_key, f"lower({_SPACES.format('$')})")
_over("st9_title_case", "headings", "heading", X.title_case, "list_aggregate(list_transform(string_split(lower($), ' '), lambda w, i: CASE WHEN list_contains(string_split('a an and as at but by for from in nor of on or the to up via with', ' '), w) AND i > 1 AND i < len(string_split($, ' ')) THEN w ELSE upper(substr(w, 1, 1)) || substr(w, 2) END), 'string_agg', ' ')")
_over("st11_nfc", "documents", "text", lambda c: X.digest(X.nfc(c)), "substr(sha256(nfc_normalize($)), 1, 16)")
_over(
    "st12_print_artifacts", "source_pages", "raw_text", lambda c: X.digest(X.print_artifacts(c)),
    "substr(sha256(replace(replace(replace(translate($, 'ſ' || chr(160) || chr(8201) || chr(8202), 's   '), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬀ', 'ff')), 1, 16)",
)
_XREF_KEY = (
    "trim(regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(translate(replace(upper(regexp_replace(regexp_replace(trim(regexp_replace({0}, '\\s+', ' ', 'g')), '^[^\\s:]+:(\\S)', '\\1'), '\\s*#\\s*', ': ', 'g')), 'Æ', 'AE'),"
    " '’‘ʼ´`', ''''''''''''), '[“”\"]', '', 'g'), '[-‐‑‒–—]', ' ', 'g'), ',', ' '), '[.\\s]+$', ''), '\\s+', ' ', 'g'))"
)
_over("st13_xref_target", "xrefs", "normalized_target", X.xref_target, _XREF_KEY.format("$"))
_over("st14_section_key", "articles", "title", X.section_key, "regexp_replace(lower($), '[^a-z0-9]+', '', 'g')")


def _words(x: str) -> str:
    return f"list_sort(list_distinct(list_filter(regexp_split_to_array(upper({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')))"


_over("st16_wordset_key", "articles", "title", lambda c: X.word_key(X.word_set(c)), f"array_to_string({_words('$')}, '|')")
_CONTENT = f"list_filter({_words('strip_accents($)')}, lambda w: length(w) > 1 AND NOT list_contains(string_split('{' '.join(X.FURNITURE)}', ' '), w))"
_over("st16_content_words", "articles", "title", lambda c: X.word_key(X.content_words(c)), f"array_to_string({_CONTENT}, '|')")
_over("st17_article_norm", "articles", "title", X.article_norm, "regexp_replace(upper(strip_accents($)), '[^A-Z0-9]+', '', 'g')")
_over("st24_qualifier", "articles", "title", X.qualifier, "CASE WHEN regexp_extract($, '\\(([^()]*)\\)\\s*$', 1) <> '' THEN regexp_extract($, '\\(([^()]*)\\)\\s*$', 1) WHEN regexp_extract($, ',\\s*([^,]+)$', 1) <> '' THEN regexp_extract($, ',\\s*([^,]+)$', 1) END")
_over("st25_suffix_cuts", "articles", "title", lambda c: F.array_join(X.suffix_cuts(F.split(c, " ")), "|"), "list_aggregate(list_transform(range(1, len(string_split($, ' ')) + 1), lambda i: array_to_string(list_slice(string_split($, ' '), i, len(string_split($, ' '))), ' ')), 'string_agg', '|')")
_over("st25_word_spans", "headings", "heading", lambda c: F.size(X.word_spans(F.split(c, " "))), "len(string_split($, ' ')) * (len(string_split($, ' ')) + 1) // 2")
_over("st27_initials_key", "contributor_initials", "initials", X.initials_key, "regexp_replace(upper(strip_accents($)), '[^A-Z]', '', 'g')")
_over("st27_contributor_slug", "contributor_initials", "initials", X.contributor_slug, "trim(regexp_replace(lower(strip_accents($)), '[^a-z0-9]+', '-', 'g'), '-')")
_HONOR = "(?i)^\\s*((" + "|".join(X.HONORIFICS) + ")\\b\\.?\\s*)+"
_over("st27_strip_honorifics", "contributors", "full_name", X.strip_honorifics, f"trim(regexp_replace($, '{_HONOR}', ''))")
_over("st27_name_key", "contributors", "full_name", X.name_key, f"array_to_string(list_sort(list_filter(regexp_split_to_array(lower(strip_accents(trim(regexp_replace($, '{_HONOR}', '')))), '[^a-z]+'), lambda w: w <> '')), ' ')")
_over("st34_surname_fold", "contributors", "full_name", lambda c: X.surname_fold(F.element_at(F.split(c, " "), -1)), "regexp_replace(lower(strip_accents(string_split($, ' ')[-1])), '^m([''’‘]|ac|c)([a-z]{3,})$', 'mc\\2')")
_over("st41_marker_names", "articles", "body", lambda c: F.array_join(X.marker_names(c), ","), "array_to_string(regexp_extract_all($, '«/?([A-Z][A-Za-z0-9_]*)(\\[[^«»]*\\])?(:|»)', 1), ',')")
_PLAIN = (
    "trim(regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace({0}, '(?s)«FN(\\[[^«»]*\\])?:.*?«/FN»', '', 'g'), '«(LN|AL|XL)(\\[[^«»]*\\])?:([^«»|]*\\|)*([^«»|]*)(»|«/(LN|AL|XL)»)', '\\4', 'g'), '«P»', ' '),"
    " '«/?[A-Z][A-Za-z0-9_]*(\\[[^«»]*\\])?(:[^«»]*»|:|»)', '', 'g'), '\\s+', ' ', 'g'))"
)
_over("st42_plain_text", "articles", "body", lambda c: X.digest(X.plain_text(c)), f"substr(sha256({_PLAIN.format('$')}), 1, 16)")
_over("st42_links_to_display", "xrefs", "surface_text", X.links_to_display, "regexp_replace($, '«(LN|AL|XL)(\\[[^«»]*\\])?:([^«»|]*\\|)*([^«»|]*)(»|«/(LN|AL|XL)»)', '\\4', 'g')")
_over("st43_match_count", "documents", "text", lambda c: X.occurrences(F.lower(c), F.lit("the")), "CAST((length(lower($)) - length(replace(lower($), 'the', ''))) / 3 AS INT)")
_over("st45_opening", "articles", "body", X.opening, f"substr({_PLAIN.format('$')}, 1, 300)")
_over("st46_media_path", "headings", "heading", X.media_path, "substr(md5(replace(trim($), ' ', '_')), 1, 1) || '/' || substr(md5(replace(trim($), ' ', '_')), 1, 2) || '/' || replace(trim($), ' ', '_')")
_over("st47_escape_html", "source_pages", "wikitext", X.escape_html, "replace(replace(replace(replace($, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')")
_over("st47_roundtrip", "source_pages", "wikitext", lambda c: X.unescape_html(X.escape_html(c)) == c, "CASE WHEN $ IS NOT NULL THEN TRUE END")
_over("st48_content_signature", "source_pages", "wikitext", X.content_signature, "sha256(array_to_string(list_filter(regexp_split_to_array(lower(regexp_replace(regexp_replace($, '<[^>]*>', ' ', 'g'), '«/?[A-Z][A-Za-z0-9_]*(\\[[^«»]*\\])?(:[^«»]*»|:|»)', ' ', 'g')), '[^a-z0-9]+'), lambda w: w <> ''), ' '))")
_over("st49_title_norm", "articles", "title", lambda c: F.trim(F.regexp_replace(F.upper(F.regexp_replace(c, r"\(.*?\)", "")), r"[^A-Z0-9]+", " ")), "trim(regexp_replace(upper(regexp_replace($, '\\(.*?\\)', '', 'g')), '[^A-Z0-9]+', ' ', 'g'))")
_over("st51_display_name", "headings", "heading", X.invert_name, "CASE WHEN strpos($, ',') > 0 THEN trim(substr($, strpos($, ',') + 1)) || ' ' || trim(substr($, 1, strpos($, ',') - 1)) WHEN strpos(trim($), ' ') > 0 THEN string_split(trim($), ' ')[-1] || ', ' || trim(substr(trim($), 1, length(trim($)) - length(string_split(trim($), ' ')[-1]))) ELSE trim($) END")
_over("st52_name_variants", "headings", "heading", lambda c: F.array_join(F.array_sort(X.name_variants(c)), "|"), "array_to_string(list_sort(list_distinct([upper(trim($)), regexp_replace(upper(trim($)), 'S$', ''), upper(trim($)) || 'S', replace(upper(trim($)), '-', ' '), regexp_replace(replace(upper(trim($)), '-', ' '), 'S$', '')])), '|')")
_over("ag22_word_count", "documents", "text", X.word_count, "len(list_filter(regexp_split_to_array(trim($, chr(9) || chr(10) || chr(13) || ' '), '\\s+'), lambda w: w <> ''))")


@query("st8_excerpt", "SELECT DISTINCT id, replace(replace(substr(body, greatest(0, strpos(body, 'until') - 1 - 60) + 1, strpos(body, 'until') - 1 + 60 - greatest(0, strpos(body, 'until') - 1 - 60)), chr(10), ' '), chr(13), '') AS part FROM articles WHERE strpos(body, 'until') > 0")
def st8_excerpt(spark, d):
    rows = table(spark, d, "articles").where(F.instr("body", "until") > 0)
    return rows.select("id", X.excerpt("body", F.instr("body", "until") - 1).alias("part")).distinct()


@query("st10_page_range", "SELECT DISTINCT id, loaded_at, CASE WHEN coalesce(CAST(page_start AS VARCHAR), '') = coalesce(CAST(page_end AS VARCHAR), '') THEN 'p. ' || coalesce(CAST(page_start AS VARCHAR), '') ELSE 'pp. ' || coalesce(CAST(page_start AS VARCHAR), '') || '–' || coalesce(CAST(page_end AS VARCHAR), '') END AS pages FROM articles")
def st10_page_range(spark, d):
    return table(spark, d, "articles").select("id", "loaded_at", X.page_range("page_start", "page_end").alias("pages")).distinct()


@query("st23_bounded_edits", "SELECT a.heading AS a, b.heading AS b FROM headings a JOIN headings b ON a.heading < b.heading AND substr(a.heading, 1, 3) = substr(b.heading, 1, 3) WHERE levenshtein(a.heading, b.heading) <= 3")
def st23_bounded_edits(spark, d):
    h = table(spark, d, "headings").select("heading", F.substring("heading", 1, 3).alias("k"))
    a, b = h.select(F.col("heading").alias("a"), "k"), h.select(F.col("heading").alias("b"), "k")
    return a.join(b, "k").where((F.col("a") < F.col("b")) & X.within("a", "b", 3)).select("a", "b")


@query("st36_stable_id", "SELECT DISTINCT id, volume, title, printf('%02d-%04d-%s', volume, page_start, substr(sha1(trim(regexp_replace(lower(trim(title)), '[^a-z0-9]+', '-', 'g'), '-')), 1, 6)) AS stable_id FROM articles")
def st36_stable_id(spark, d):
    return table(spark, d, "articles").select("id", "volume", "title", X.stable_id("volume", "page_start", "title").alias("stable_id")).distinct()


@query("st44_prose_window", """SELECT x.id, CASE WHEN strpos(a.body, x.t) > 0 THEN substr(a.body, greatest(1, strpos(a.body, x.t) - 140), strpos(a.body, x.t) + length(x.t) + 140 - greatest(1, strpos(a.body, x.t) - 140)) END AS prose
FROM (SELECT DISTINCT id, article_id, surface_text AS t FROM xrefs WHERE surface_text <> '') x JOIN (SELECT id, arg_max(body, loaded_at) AS body FROM articles GROUP BY id) a ON a.id = x.article_id""")
def st44_prose_window(spark, d):
    bodies = table(spark, d, "articles").groupBy("id").agg(F.max_by("body", "loaded_at").alias("body")).select(F.col("id").alias("article_id"), "body")
    refs = table(spark, d, "xrefs").where(F.col("surface_text") != "").select("id", "article_id", F.col("surface_text").alias("t")).distinct()
    return refs.join(bodies, "article_id").select("id", X.prose_window("body", "t").alias("prose"))


@query("st38_source_cleanup", "SELECT DISTINCT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(wikitext, '(?s)<!--.*?-->', '', 'g'), '(?s)<noinclude>.*?</noinclude>', '', 'g'), '</?includeonly>', '', 'g'), '[ \\t]+(\\n|$)', '\\1', 'g') AS cleaned FROM source_pages WHERE wikitext IS NOT NULL")
def st38_source_cleanup(spark, d):
    t = F.col("wikitext")
    for pattern, instead in ((r"(?s)<!--.*?-->", ""), (r"(?s)<noinclude>.*?</noinclude>", ""), ("</?includeonly>", ""), (r"[ \t]+(\n|$)", "$1")):
        t = F.regexp_replace(t, pattern, instead)
    return table(spark, d, "source_pages").where("wikitext IS NOT NULL").select("id", t.alias("cleaned")).distinct()


@query("st53_index_topic", "SELECT DISTINCT display, trim(regexp_replace(regexp_replace(display, '\\s*\\d{1,2}-\\d{1,4}', '', 'g'), '[.,]+$', '')) AS topic, CASE WHEN length(display) < 20 THEN 'short' ELSE 'long' END AS size FROM vol29_entries")
def st53_index_topic(spark, d):
    topic = F.trim(F.regexp_replace(F.regexp_replace("display", r"\s*\d{1,2}-\d{1,4}", ""), "[.,]+$", ""))
    return table(spark, d, "vol29_entries").select("display", topic.alias("topic"), F.when(F.length("display") < 20, "short").otherwise("long").alias("size")).distinct()


@query("st24_alternates", r"""WITH t AS (SELECT DISTINCT title, trim(regexp_replace(regexp_replace(title, '\s*\([^()]*\)', '', 'g'), '\s+', ' ', 'g')) AS bare FROM articles WHERE title IS NOT NULL),
u AS (SELECT title, trim(regexp_replace(title, '\s+', ' ', 'g')) AS spelling FROM t UNION SELECT title, bare FROM t UNION SELECT title, trim(regexp_extract(title, '\(([^()]*)\)', 1)) FROM t UNION SELECT title, trim(unnest(regexp_split_to_array(bare, '(?i)\s+or\s+'))) FROM t) SELECT * FROM u WHERE spelling <> ''""")
def st24_alternates(spark, d):
    return _titles(spark, d).select("title", F.explode(X.alternates("title")).alias("spelling"))


@query("st27_honorific_set", r"SELECT DISTINCT full_name, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(lower(regexp_extract(full_name, '(?i)^\s*((sir|rev|revd|the|hon|dr|prof|lord|lady|capt|col|general|gen|major|maj|very|right|rt|mr|mrs|miss)\b\.?\s*)+')), '[\s.]+'), lambda w: w <> ''))), ' ') AS titles FROM contributors")
def st27_honorific_set(spark, d):
    return table(spark, d, "contributors").select("full_name", F.array_join(X.honorific_set("full_name"), " ").alias("titles")).distinct()
