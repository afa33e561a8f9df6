"""Join operators over the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiloom.functions import text as X
from lexiloom.operators import intervals, ladder
from lexiloom.operators.ordered import last_known
from lexiloom.operators.skew import left_join_unique
from lexiloom.plans.common import HEAD, REFS, VA, VC, Registry, head_key, once, valid
from lexiloom.tables import table

query = Registry()
QUERIES, SQL = query.queries, query.sql


def refs(spark, d):
    """The distinct targets of references, upper-cased, on one space."""
    return table(spark, d, "xrefs").where("normalized_target IS NOT NULL").select(X.collapse_spaces(F.upper("normalized_target")).alias("ref")).distinct()


def titles(spark, d):
    return table(spark, d, "headings").select(F.upper("heading").alias("title")).distinct()


@query("jn1_segment_page", "SELECT s.id, s.article_id, p.volume, p.page_number, s.sequence_in_article AS seq FROM (SELECT DISTINCT id, article_id, source_page_id, sequence_in_article FROM article_segments) s JOIN (SELECT DISTINCT id, volume, page_number FROM source_pages) p ON p.id = s.source_page_id")
def jn1(spark, d):
    pages = once(spark, d, "source_pages", "id", "volume", "page_number").withColumnRenamed("id", "source_page_id")
    segments = once(spark, d, "article_segments", "id", "article_id", "source_page_id", "sequence_in_article")
    return segments.join(pages, "source_page_id").select("id", "article_id", "volume", "page_number", F.col("sequence_in_article").alias("seq"))


@query("jn2_covered_pages", f"WITH {VA} SELECT DISTINCT s.source_page_id AS page_id FROM article_segments s JOIN va ON va.id = s.article_id")
def jn2(spark, d):
    live = valid(spark, d).select(F.col("id").alias("article_id"))
    return table(spark, d, "article_segments").join(live, "article_id", "left_semi").select(F.col("source_page_id").alias("page_id")).distinct()


@query("jn3_initials", f"WITH {VC} SELECT DISTINCT i.id, i.initials, vc.full_name FROM contributor_initials i JOIN vc ON vc.id = i.contributor_id")
def jn3(spark, d):
    people = valid(spark, d, "contributors").select(F.col("id").alias("contributor_id"), "full_name")
    return table(spark, d, "contributor_initials").join(people, "contributor_id").select("id", "initials", "full_name").distinct()


@query("jn4_range_join", f"WITH {VA} SELECT va.id AS article_id, p.id AS page_id FROM va JOIN (SELECT DISTINCT id, volume, page_number FROM source_pages) p ON p.volume = va.volume AND p.page_number BETWEEN va.page_start AND va.page_end")
def jn4(spark, d):
    pages = once(spark, d, "source_pages", "id", "volume", "page_number").withColumnRenamed("id", "page_id")
    spans = valid(spark, d).select(F.col("id").alias("article_id"), "volume", "page_start", "page_end")
    return intervals.range_join(spans, pages, ["volume"], "page_start", "page_end", "page_number").select("article_id", "page_id")


@query("jn4_order_window", "SELECT l_orderkey, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 30 DAY")
def jn4_orders(spark, d):
    orders, lines = table(spark, d, "orders").select("o_orderkey", "o_orderdate"), table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    met = lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
    return met.where(F.col("l_shipdate").between(F.col("o_orderdate"), F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"))).select("l_orderkey", "l_linenumber")


@query("jn5_first_on_page", f"WITH {VA} SELECT volume, page, min_by(title, (page_start, id)) AS title FROM (SELECT volume, unnest(generate_series(page_start, page_end)) AS page, title, page_start, id FROM va) GROUP BY volume, page")
def jn5(spark, d):
    spread = valid(spark, d).where("page_start <= page_end").select("volume", F.explode(F.sequence("page_start", "page_end")).alias("page"), "title", "page_start", "id")
    return intervals.first_wins(spread, ["volume", "page"], ["page_start", "id"]).select("volume", "page", "title")


@query("jn6_asof_page", """WITH marks AS (SELECT article_id, body_offset, max(source_page_id) AS page FROM article_segments GROUP BY 1, 2),
probes AS (SELECT DISTINCT id, article_id, body_offset + 100 AS at FROM article_segments)
SELECT p.id, p.at, m.page FROM probes p ASOF LEFT JOIN marks m ON p.article_id = m.article_id AND p.at >= m.body_offset""")
def jn6(spark, d):
    segments = once(spark, d, "article_segments", "id", "article_id", "source_page_id", "body_offset")
    marks = segments.groupBy("article_id", "body_offset").agg(F.max("source_page_id").alias("page"))
    probes = segments.select("id", "article_id", (F.col("body_offset") + 100).alias("at"))
    return intervals.asof(probes, marks, ["article_id"], "at", "body_offset", "page", "page").select("id", "at", "page")


@query("jn6_asof_event", """WITH marks AS (SELECT user_id, ts, max(event_id) AS last_id FROM events WHERE event_type = (SELECT min(event_type) FROM events) GROUP BY 1, 2)
SELECT e.event_id, m.last_id FROM events e ASOF LEFT JOIN marks m ON e.user_id = m.user_id AND e.ts >= m.ts""")
def jn6_events(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    kind = events.agg(F.min("event_type").alias("event_type"))
    marks = events.join(F.broadcast(kind), "event_type").groupBy("user_id", F.col("ts").alias("mark_ts")).agg(F.max("event_id").alias("last_id"))
    return intervals.asof(events, marks, ["user_id"], "ts", "mark_ts", "last_id", "last_id").select("event_id", "last_id")


@query("jn7_section_at", f"""WITH {VA}, s AS (SELECT volume, page_start, max(section_name) AS section_name FROM va WHERE section_name IS NOT NULL GROUP BY 1, 2)
SELECT p.id, s.section_name FROM (SELECT DISTINCT id, volume, page_number FROM source_pages) p ASOF LEFT JOIN s ON p.volume = s.volume AND p.page_number >= s.page_start""")
def jn7(spark, d):
    marks = valid(spark, d).where("section_name IS NOT NULL").groupBy("volume", "page_start").agg(F.max("section_name").alias("section_name"))
    pages = once(spark, d, "source_pages", "id", "volume", "page_number")
    return intervals.asof(pages, marks, ["volume"], "page_number", "page_start", "section_name", "section_name").select("id", "section_name")


@query("jn8_interval_clip", f"""WITH {VA}, p AS (SELECT DISTINCT volume, page_number FROM source_pages)
SELECT va.id, p.page_number - va.page_start AS "offset" FROM va JOIN p ON p.volume = va.volume AND p.page_number > va.page_start AND p.page_number <= va.page_end
UNION ALL SELECT id, 0 FROM va""")
def jn8(spark, d):
    marks = once(spark, d, "source_pages", "volume", "page_number")
    spans = valid(spark, d).select("id", "volume", "page_start", "page_end")
    return intervals.clip(spans, marks, ["volume"], "page_start", "page_end", "page_number").select("id", "offset")


def _w(x: str) -> str:
    return f"list_sort(list_distinct(list_filter(regexp_split_to_array(upper({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')))"


def _c(x: str) -> str:
    return f"list_filter({_w(f'strip_accents({x})')}, lambda w: length(w) > 1 AND NOT list_contains(string_split('{' '.join(X.FURNITURE)}', ' '), w))"


_T = "titles AS (SELECT DISTINCT upper(heading) AS title FROM headings)"
_EXACT = f"SELECT ref, title FROM refs JOIN titles ON {_w('ref')} = {_w('title')} WHERE len({_w('ref')}) > 0"
_FOLD = f"SELECT ref, title FROM refs JOIN titles ON {_w('strip_accents(ref)')} = {_w('strip_accents(title)')} WHERE len({_w('ref')}) > 0"
_SUBSET = f"SELECT ref, title FROM (SELECT ref, {_c('ref')} AS a FROM refs) r, (SELECT title, {_w('strip_accents(title)')} AS b FROM titles) t WHERE len(a) > 0 AND list_has_all(b, a)"
_INSIDE = f"SELECT ref, title, len(b) AS n, rank() OVER (PARTITION BY ref ORDER BY len(b) DESC) AS place FROM (SELECT ref, {_c('ref')} AS a FROM refs) r, (SELECT title, {_c('title')} AS b FROM titles) t WHERE len(b) > 0 AND list_has_all(a, b)"
_SUPERSET = f"SELECT ref, title FROM ({_INSIDE}) WHERE place = 1 AND (n > 1 OR (contains(ref, ',') AND {_c('split_part(ref, chr(44), 1)')} = {_c('title')}))"
_FIRST = f"SELECT ref, title FROM (SELECT ref, list_filter(regexp_split_to_array(upper(strip_accents(ref)), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')[1] AS w FROM refs) r, titles t WHERE list_contains({_w('strip_accents(title)')}, r.w)"

for _name, _rung, _sql in (("jn9_exact", ladder.exact, _EXACT), ("jn10_fold", ladder.folded, _FOLD), ("jn11_subset", ladder.subset, _SUBSET), ("jn12_superset", ladder.superset, _SUPERSET), ("jn13_firstword", ladder.first_word, _FIRST)):
    query(_name, f"WITH {REFS}, {_T} {_sql}")(lambda spark, d, rung=_rung: rung(refs(spark, d), titles(spark, d)))

query("rs1_ladder", f"""WITH {REFS}, {_T}, e AS ({_EXACT}), f AS ({_FOLD}), s AS ({_SUBSET}), p AS ({_SUPERSET}), w AS ({_FIRST}),
u AS (SELECT *, 0 AS place, 'exact' AS rung FROM e UNION ALL SELECT *, 1, 'fold' FROM f UNION ALL SELECT *, 2, 'subset' FROM s UNION ALL SELECT *, 3, 'superset' FROM p UNION ALL SELECT *, 4, 'firstword' FROM w)
SELECT ref, title, rung FROM (SELECT *, dense_rank() OVER (PARTITION BY ref ORDER BY place) AS r FROM u) WHERE r = 1""")(lambda spark, d: ladder.ladder(refs(spark, d), titles(spark, d)))


@query("jn14_title_bags", f"WITH {VA} SELECT key, count(*) AS n, min_by(title, id) AS first_title FROM (SELECT regexp_replace(upper(strip_accents(title)), '[^A-Z0-9]+', '', 'g') AS key, title, id FROM va) GROUP BY key")
def jn14(spark, d):
    rows = valid(spark, d).select(X.article_norm("title").alias("key"), "title", "id")
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min_by("title", "id").alias("first_title"))


_NORM = "trim(regexp_replace(translate(regexp_replace(upper(trim({0})), '[-‐‑‒–—]', ' ', 'g'), ',', ' '), '\\s+', ' ', 'g'))"


@query("jn15_two_keys", f"""WITH {REFS}, t AS (SELECT heading_id, heading FROM headings), a AS (SELECT {_NORM.format('heading')} AS k, min(heading_id) AS by_fold FROM t GROUP BY 1), b AS (SELECT upper(trim(heading)) AS k, min(heading_id) AS as_written FROM t GROUP BY 1)
SELECT ref, by_fold, as_written FROM refs LEFT JOIN a ON a.k = {_NORM.format('ref')} LEFT JOIN b ON b.k = ref""")
def jn15(spark, d):
    def norm(c):
        return X.collapse_spaces(F.translate(F.regexp_replace(F.upper(F.trim(c)), "[-‐‑‒–—]", " "), ",", " "))

    t = table(spark, d, "headings")
    by_fold = t.groupBy(norm("heading").alias("k")).agg(F.min("heading_id").alias("by_fold"))
    written = t.groupBy(F.upper(F.trim("heading")).alias("ref")).agg(F.min("heading_id").alias("as_written"))
    return left_join_unique(refs(spark, d).withColumn("k", norm("ref")), by_fold, "k").join(written, "ref", "left").select("ref", "by_fold", "as_written")


_SPELLED = r"""WITH {refs}, {titles}, v AS (SELECT ref, 1 AS place, 'plural' AS how, CASE WHEN ends_with(ref, 'IES') THEN left(ref, length(ref) - 3) || 'Y' END AS title FROM refs UNION ALL SELECT ref, 2, 'plural', CASE WHEN ends_with(ref, 'ES') THEN left(ref, length(ref) - 2) END FROM refs
UNION ALL SELECT ref, 3, 'plural', CASE WHEN ends_with(ref, 'S') AND NOT ends_with(ref, 'SS') THEN left(ref, length(ref) - 1) END FROM refs UNION ALL SELECT ref, 4, 'plural', ref || 'S' FROM refs UNION ALL SELECT ref, 5, 'plural', ref || 'ES' FROM refs
UNION ALL SELECT ref, 6, 'plural', CASE WHEN ends_with(ref, 'Y') THEN left(ref, length(ref) - 1) || 'IES' END FROM refs
UNION ALL SELECT ref, 7, 'inversion', CASE WHEN contains(ref, ' ') AND NOT contains(ref, ',') THEN string_split(ref, ' ')[-1] || ', ' || array_to_string(string_split(ref, ' ')[:-2], ' ') END FROM refs
UNION ALL SELECT ref, 8, 'inversion', CASE WHEN contains(ref, ', ') THEN substr(ref, strpos(ref, ', ') + 2) || ' ' || left(ref, strpos(ref, ', ') - 1) END FROM refs
UNION ALL SELECT ref, 9, 'article', CASE WHEN ends_with(ref, ', THE') THEN left(ref, length(ref) - 5) ELSE ref || ', THE' END FROM refs UNION ALL SELECT ref, 10, 'period', CASE WHEN ends_with(ref, '.') THEN rtrim(ref, '.') ELSE ref || '.' END FROM refs
UNION ALL SELECT ref, 12, 'section', CASE WHEN contains(ref, ': ') THEN trim(regexp_extract(ref, '^(.*): ', 1)) END FROM refs UNION ALL SELECT ref, 13, 'bracket', trim(regexp_extract(ref, '^(.+?)\s*\([^)]+\)\s*$', 1)) FROM refs)
SELECT ref, min_by(title, (place, title)) AS title, min_by(how, (place, title)) AS how FROM v JOIN titles USING (title) WHERE length(title) >= 3 GROUP BY ref""".replace("{refs}", REFS).replace("{titles}", _T)


@query("st18_spellings", _SPELLED)
def st18(spark, d):
    return ladder.spelled(refs(spark, d), titles(spark, d))


query("st19_inversion", f"WITH {REFS}, {_T}, v AS (SELECT ref, CASE WHEN contains(ref, ', ') THEN substr(ref, strpos(ref, ', ') + 2) || ' ' || substr(ref, 1, strpos(ref, ', ') - 1) WHEN NOT contains(ref, ',') AND contains(ref, ' ') THEN string_split(ref, ' ')[-1] || ', ' || substr(ref, 1, length(ref) - length(string_split(ref, ' ')[-1]) - 1) END AS title FROM refs) SELECT ref, title FROM v JOIN titles USING (title)")(
    lambda spark, d: refs(spark, d).select("ref", F.explode(F.filter(ladder.variants(F.col("ref")), lambda v: v["how"] == "inversion")).alias("v")).select("ref", F.col("v.key").alias("title")).join(titles(spark, d), "title").select("ref", "title")
)
_FI = "list_transform(list_filter(regexp_split_to_array(trim(substr({0}, strpos({0}, ', ') + 2)), '\\s+'), lambda w: w <> ''), lambda w: substr(w, 1, 1))"
query("st20_initials", f"""WITH {REFS}, {_T}, r AS (SELECT ref, split_part(ref, ', ', 1) AS l, {_FI.format('ref')} AS fi FROM refs WHERE contains(ref, ', ')), t AS (SELECT title, split_part(title, ', ', 1) AS l, {_FI.format('title')} AS ti FROM titles WHERE contains(title, ', '))
SELECT ref, min_by(title, (length(title), title)) AS title FROM r JOIN t USING (l) WHERE len(fi) > 0 AND len(list_filter(fi, lambda c: NOT regexp_matches(c, '[A-Z]'))) = 0 AND len(ti) >= len(fi) AND list_slice(ti, 1, len(fi)) = fi GROUP BY ref""")(lambda spark, d: ladder.initials(refs(spark, d), titles(spark, d)))
query("st21_qualifier_cut", f"WITH {REFS}, {_T}, p AS (SELECT ref, list_transform(string_split(ref, ','), lambda x: trim(x)) AS a FROM refs), c AS (SELECT ref, i, array_to_string(list_slice(a, 1, i), ', ') AS title FROM (SELECT ref, a, unnest(range(1, len(a))) AS i FROM p)) SELECT ref, max_by(title, i) AS title FROM c JOIN titles USING (title) WHERE length(title) >= 3 GROUP BY ref")(
    lambda spark, d: ladder.trailing_qualifier(refs(spark, d), titles(spark, d))
)
query("st22_fold_strategy", f"WITH {REFS}, {_T} SELECT ref, title FROM refs JOIN titles ON strip_accents(ref) = strip_accents(title) WHERE ref <> ''")(lambda spark, d: ladder._by_key(refs(spark, d), titles(spark, d), X.fold_accents))
query("jn17_prefix", f"WITH {REFS}, {_T} SELECT ref, min_by(title, (length(title), title)) AS title FROM refs JOIN titles ON starts_with(title, ref) AND title <> ref AND substr(title, length(ref) + 1, 1) IN (',', ' ', '-') WHERE length(ref) >= 4 GROUP BY ref")(
    lambda spark, d: ladder.prefix(refs(spark, d), titles(spark, d))
)
query("jn18_edit1_blocked", f"WITH {REFS}, {_T} SELECT ref, min_by(title, (length(title), title)) AS title FROM refs JOIN titles ON substr(ref, 1, 1) = substr(title, 1, 1) AND abs(length(ref) - length(title)) <= 1 AND ref <> title AND levenshtein(regexp_replace(ref, '[^ -~]', '#', 'g'), regexp_replace(title, '[^ -~]', '#', 'g')) <= 1 WHERE length(ref) >= 4 GROUP BY ref")(
    lambda spark, d: ladder.edit_one(refs(spark, d), titles(spark, d))
)


@query("jn20_plate_parent", f"""WITH {VA}, p AS (SELECT id, volume, page_start, title FROM va WHERE article_type = 'plate'), a AS (SELECT id, volume, page_start, page_end, title FROM va WHERE article_type IS DISTINCT FROM 'plate')
SELECT p.id AS plate_id, min_by(a.id, (CASE WHEN a.title = p.title THEN 0 WHEN starts_with(p.title, a.title) THEN 1 ELSE 2 END, CASE WHEN p.page_start BETWEEN a.page_start AND a.page_end THEN 0 ELSE 1 END, p.page_start - a.page_start, a.id)) AS parent_id
FROM p JOIN a ON a.volume = p.volume AND a.page_start <= p.page_start GROUP BY p.id""")
def jn20(spark, d):
    """A plate's article: one of its title, of a beginning of its title, on its page, or the last before it, in this order.

    The first two are equi-joins on the title and its beginnings, the third a range join and the last an
    as-of join, so an article at any distance is met and no plate meets all of its volume.
    """
    rows = valid(spark, d).select("id", "volume", "page_start", "page_end", "title", F.coalesce("article_type", F.lit("")).alias("kind"))
    plates = rows.where("kind = 'plate'").select(F.col("id").alias("plate_id"), "volume", F.col("page_start").alias("at"), F.col("title").alias("plate_title"))
    parents = rows.where("kind <> 'plate'").select("id", "volume", "page_start", "page_end", "title")
    heads = plates.withColumn("title", F.explode(F.transform(F.sequence(F.lit(1), F.length("plate_title")), lambda i: F.substring(F.col("plate_title"), F.lit(1), i))))
    named = heads.join(parents, ["volume", "title"]).where("page_start <= at").select("plate_id", "at", "plate_title", *[F.col(c) for c in ("id", "page_start", "page_end", "title")])
    covering = intervals.range_join(parents, plates, ["volume"], "page_start", "page_end", "at", 32).select("plate_id", "at", "plate_title", "id", "page_start", "page_end", "title")
    marks = parents.groupBy("volume", "page_start").agg(F.min(F.struct("id", "page_start", "page_end", "title")).alias("near"))
    nearest = intervals.asof(plates, marks, ["volume"], "at", "page_start", "near", "near").where("near IS NOT NULL").select("plate_id", "at", "plate_title", "near.*")
    likeness = F.when(F.col("title") == F.col("plate_title"), 0).when(F.col("plate_title").startswith(F.col("title")), 1).otherwise(2)
    covers = F.when(F.col("at").between(F.col("page_start"), F.col("page_end")), 0).otherwise(1)
    met = named.unionByName(covering).unionByName(nearest)
    return met.groupBy("plate_id").agg(F.min_by("id", F.struct(likeness, covers, F.col("at") - F.col("page_start"), "id")).alias("parent_id"))


_STEPS = [("exact", f"WITH {REFS}, {_T} SELECT ref, title FROM refs JOIN titles ON ref = title"), ("spelling", _SPELLED)]
_STEPS += [(how, SQL[name]) for how, name in (("initials", "st20_initials"), ("prefix", "jn17_prefix"), ("qualifier", "st21_qualifier_cut"), ("fold", "st22_fold_strategy"), ("edit", "jn18_edit1_blocked"))]


@query("jn16_cascade", "WITH u AS (" + " UNION ALL ".join(f"SELECT ref, min(title) AS title, '{how}' AS how, {i} AS place FROM ({sql}) GROUP BY ref" for i, (how, sql) in enumerate(_STEPS)) + ") SELECT ref, min_by(title, place) AS title, min_by(how, place) AS how FROM u GROUP BY ref")
def jn16(spark, d):
    """Each strategy on what the ones before it left."""
    return ladder.cascade(refs(spark, d), titles(spark, d), aggressive=True)


_SNAP = "old AS (SELECT DISTINCT volume, regexp_replace(upper(strip_accents(title)), '[^A-Z0-9]+', '', 'g') AS k FROM articles WHERE loaded_at < TIMESTAMP '2024-01-01'), new AS (SELECT DISTINCT volume, regexp_replace(upper(strip_accents(title)), '[^A-Z0-9]+', '', 'g') AS k FROM articles WHERE loaded_at >= TIMESTAMP '2023-06-01')"


def _snapshots(spark, d):
    rows = table(spark, d, "articles").select("volume", X.article_norm("title").alias("k"), "loaded_at")
    return rows.where("loaded_at < TIMESTAMP_NTZ '2024-01-01 00:00:00'").drop("loaded_at").distinct(), rows.where("loaded_at >= TIMESTAMP_NTZ '2023-06-01 00:00:00'").drop("loaded_at").distinct()


@query("jn21_missing_spurious", f"WITH {_SNAP} SELECT volume, k, 'missing' AS side FROM (SELECT * FROM old EXCEPT SELECT * FROM new) UNION ALL SELECT volume, k, 'spurious' FROM (SELECT * FROM new EXCEPT SELECT * FROM old)")
def jn21(spark, d):
    old, new = _snapshots(spark, d)
    return old.join(new, ["volume", "k"], "left_anti").withColumn("side", F.lit("missing")).unionByName(new.join(old, ["volume", "k"], "left_anti").withColumn("side", F.lit("spurious")))


@query("jn22_known_titles", f"WITH {VA} SELECT heading_id, heading FROM headings WHERE heading NOT IN (SELECT title FROM va WHERE title IS NOT NULL)")
def jn22(spark, d):
    known = valid(spark, d).where("title IS NOT NULL").select(F.col("title").alias("heading"))
    return table(spark, d, "headings").join(known, "heading", "left_anti").select("heading_id", "heading")


@query("jn23_uncovered", "SELECT DISTINCT id, volume, page_number FROM source_pages p WHERE length(raw_text) >= 200 AND NOT EXISTS (SELECT 1 FROM article_segments s WHERE s.source_page_id = p.id AND s.loaded_at < TIMESTAMP '2023-01-01') AND page_number >= (SELECT min(page_start) FROM articles a WHERE a.volume = p.volume)")
def jn23(spark, d):
    """Pages of text inside a volume that no article covered yet in the snapshot of a day."""
    first = table(spark, d, "articles").groupBy("volume").agg(F.min("page_start").alias("first"))
    pages = table(spark, d, "source_pages").where(F.length("raw_text") >= 200).select("id", "volume", "page_number")
    covered = table(spark, d, "article_segments").where("loaded_at < TIMESTAMP_NTZ '2023-01-01 00:00:00'").select(F.col("source_page_id").alias("id"))
    return pages.join(covered, "id", "left_anti").join(first, "volume").where("page_number >= first").select("id", "volume", "page_number").distinct()


@query("jn24_snapshot_diff", """WITH b AS (SELECT id, max_by(sha256(body), loaded_at) AS h, max_by(title, loaded_at) AS t FROM articles WHERE loaded_at < TIMESTAMP '2024-01-01' GROUP BY id), n AS (SELECT id, max_by(sha256(body), loaded_at) AS h, max_by(title, loaded_at) AS t FROM articles WHERE loaded_at >= TIMESTAMP '2023-06-01' GROUP BY id)
SELECT coalesce(b.id, n.id) AS id, CASE WHEN n.id IS NULL THEN 'disappeared' WHEN b.id IS NULL THEN 'new' WHEN b.h IS DISTINCT FROM n.h THEN 'content' WHEN b.t IS DISTINCT FROM n.t THEN 'title' ELSE 'same' END AS change FROM b FULL JOIN n ON b.id = n.id""")
def jn24(spark, d):
    rows = table(spark, d, "articles").select("id", "title", F.sha2("body", 256).alias("h"), "loaded_at")

    def side(condition, s):
        return rows.where(condition).groupBy("id").agg(F.max_by("h", "loaded_at").alias(f"h{s}"), F.max_by("title", "loaded_at").alias(f"t{s}"), F.lit(True).alias(f"is{s}"))

    both = side("loaded_at < TIMESTAMP_NTZ '2024-01-01 00:00:00'", 1).join(side("loaded_at >= TIMESTAMP_NTZ '2023-06-01 00:00:00'", 2), "id", "full_outer")
    change = F.when(F.col("is2").isNull(), "disappeared").when(F.col("is1").isNull(), "new").when(~F.col("h1").eqNullSafe(F.col("h2")), "content").when(~F.col("t1").eqNullSafe(F.col("t2")), "title").otherwise("same")
    return both.select("id", change.alias("change"))


@query("jn25_label_shift", """WITH b AS (SELECT id, min_by(coalesce(article_type, '-'), loaded_at) AS l FROM articles GROUP BY id), n AS (SELECT id, max_by(coalesce(article_type, '-'), loaded_at) AS l FROM articles GROUP BY id)
SELECT b.l AS before, n.l AS after, count(*) AS n FROM b FULL JOIN n ON b.id = n.id GROUP BY 1, 2""")
def jn25(spark, d):
    kind = F.coalesce("article_type", F.lit("-"))
    both = table(spark, d, "articles").groupBy("id").agg(F.min_by(kind, F.col("loaded_at")).alias("before"), F.max_by(kind, F.col("loaded_at")).alias("after"))
    return both.groupBy("before", "after").agg(F.count(F.lit(1)).alias("n"))


@query("jn26_missing_targets", f"WITH {VA} SELECT target, count(*) AS n FROM (SELECT trim(unnest(regexp_extract_all(body, '«LN:([^«»|]*)', 1))) AS target FROM va) WHERE upper(target) NOT IN (SELECT upper(title) FROM articles WHERE title IS NOT NULL) GROUP BY target")
def jn26(spark, d):
    links = valid(spark, d).select(F.explode(F.regexp_extract_all("body", F.lit("«LN:([^«»|]*)"), F.lit(1))).alias("t")).select(F.trim("t").alias("target"), F.upper(F.trim("t")).alias("k"))
    known = table(spark, d, "articles").where("title IS NOT NULL").select(F.upper("title").alias("k")).distinct()
    return links.join(known, "k", "left_anti").groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query("jn27_homonym_frame", f"WITH g AS (SELECT {HEAD.format('heading')} AS k, count(*) AS n FROM headings GROUP BY 1 HAVING count(*) > 1) SELECT DISTINCT x.id, g.k, g.n FROM xrefs x JOIN g ON g.k = {HEAD.format('x.normalized_target')}")
def jn27(spark, d):
    """References to what several headings are called, such as a river and the town on it."""
    families = table(spark, d, "headings").groupBy(head_key("heading").alias("k")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    links = table(spark, d, "xrefs").select("id", head_key("normalized_target").alias("k")).distinct()
    return links.join(families, "k").select("id", "k", "n")


#: Credits: who or what an author reference names, and the article that makes it.
_CREDITS = "SELECT DISTINCT id AS credit_id, article_id AS by_article, normalized_target AS subject FROM xrefs WHERE xref_type = 'author' AND normalized_target IS NOT NULL"


def credits(spark, d):
    rows = table(spark, d, "xrefs").where("xref_type = 'author' AND normalized_target IS NOT NULL")
    return rows.select(F.col("id").alias("credit_id"), F.col("article_id").alias("by_article"), F.col("normalized_target").alias("subject")).distinct()


@query("jn28_bind_subjects", f"WITH {VA}, c AS ({_CREDITS}) SELECT DISTINCT c.credit_id, va.id AS article_id FROM c JOIN va ON {HEAD.format('va.title')} = {HEAD.format('c.subject')} WHERE va.id NOT IN (SELECT target_article_id FROM xrefs WHERE target_article_id IS NOT NULL AND xref_type = 'see')")
def jn28(spark, d):
    """Articles that a credit's subject names and that no *see* is bound to already."""
    rows = valid(spark, d).select(F.col("id").alias("article_id"), head_key("title").alias("k"))
    bound = table(spark, d, "xrefs").where("xref_type = 'see'").select(F.col("target_article_id").alias("article_id"))
    return credits(spark, d).withColumn("k", head_key("subject")).join(rows, "k").join(bound, "article_id", "left_anti").select("credit_id", "article_id").distinct()


@query("jn29_credit_candidates", f"""WITH {VA}, c AS (SELECT DISTINCT normalized_target AS credit FROM xrefs WHERE xref_type = 'author' AND normalized_target IS NOT NULL),
u AS (SELECT credit, id, 1 AS p FROM c JOIN va ON upper(title) = upper(credit) UNION ALL SELECT credit, id, 2 FROM c JOIN va ON upper(title) = upper(string_split(credit, ' ')[-1] || ', ' || string_split(credit, ' ')[1]) UNION ALL SELECT credit, id, 3 FROM c JOIN va ON upper(split_part(title, ',', 1)) = upper(split_part(credit, ',', 1)))
SELECT DISTINCT credit, id, p FROM (SELECT *, dense_rank() OVER (PARTITION BY credit ORDER BY p) AS r FROM u) WHERE r = 1""")
def jn29(spark, d):
    from pyspark.sql import Window

    credits = table(spark, d, "xrefs").where("xref_type = 'author' AND normalized_target IS NOT NULL").select(F.col("normalized_target").alias("credit")).distinct()
    rows = valid(spark, d).select("id", F.upper("title").alias("t"), F.upper(F.substring_index("title", ",", 1)).alias("h"))
    words = F.split("credit", " ")
    keys = [(F.upper("credit"), "t"), (F.upper(F.concat(F.element_at(words, -1), F.lit(", "), F.element_at(words, 1))), "t"), (F.upper(F.substring_index("credit", ",", 1)), "h")]
    out = None
    for p, (key, on) in enumerate(keys, 1):
        hit = credits.withColumn("k", key).join(rows.select("id", F.col(on).alias("k")), "k").select("credit", "id", F.lit(p).alias("p"))
        out = hit if out is None else out.unionByName(hit)
    return out.withColumn("r", F.dense_rank().over(Window.partitionBy("credit").orderBy("p"))).where("r = 1").select("credit", "id", "p").distinct()


_NK = "array_to_string(list_sort(list_filter(regexp_split_to_array(lower(strip_accents({0})), '[^a-z]+'), lambda w: w <> '')), ' ')"


@query("jn30_name_tokens", f"WITH {VC}, e AS (SELECT DISTINCT id, {_NK.format('full_name')} AS k FROM vol29_entries WHERE full_name IS NOT NULL) SELECT e.id AS entry_id, vc.id AS contributor_id FROM e JOIN vc ON {_NK.format('vc.full_name')} = e.k WHERE e.k <> ''")
def jn30(spark, d):
    def key(c):
        return F.array_join(F.array_sort(F.filter(F.split(F.lower(X.fold_accents(c)), "[^a-z]+"), lambda w: w != "")), " ")

    entries = table(spark, d, "vol29_entries").where("full_name IS NOT NULL").select(F.col("id").alias("entry_id"), key("full_name").alias("k")).distinct()
    people = valid(spark, d, "contributors").select(F.col("id").alias("contributor_id"), key("full_name").alias("k"))
    return entries.where("k <> ''").join(people, "k").select("entry_id", "contributor_id")


@query("jn31_page_maps", """WITH p AS (SELECT DISTINCT id, volume, page_number, regexp_extract(wikitext, '\\{\\{rh\\|(\\d+)\\|', 1) AS printed FROM source_pages), m AS (SELECT volume, page_number, max(CAST(printed AS INT)) AS printed FROM p WHERE printed <> '' GROUP BY 1, 2)
SELECT p.id, p.volume, p.page_number, coalesce(m.printed, p.page_number) AS printed_page, p.page_number + 12 AS leaf FROM (SELECT DISTINCT id, volume, page_number FROM p) p LEFT JOIN m ON m.volume = p.volume AND m.page_number = p.page_number""")
def jn31(spark, d):
    pages = table(spark, d, "source_pages").select("id", "volume", "page_number", F.regexp_extract("wikitext", r"\{\{rh\|(\d+)\|", 1).alias("printed"))
    printed = pages.where("printed <> ''").groupBy("volume", "page_number").agg(F.max(F.col("printed").cast("int")).alias("printed"))
    return pages.drop("printed").distinct().join(printed, ["volume", "page_number"], "left").select("id", "volume", "page_number", F.coalesce("printed", "page_number").alias("printed_page"), (F.col("page_number") + 12).alias("leaf"))


@query("jn19_dup_pairs", f"""WITH {VC}, t AS (SELECT id, {_NK.format('full_name')} AS k, lower(strip_accents(string_split(trim(full_name), ' ')[-1])) AS block, list_distinct(list_filter(regexp_split_to_array(lower(strip_accents(full_name)), '[^a-z]+'), lambda w: w <> '')) AS w FROM vc WHERE full_name IS NOT NULL)
SELECT a.id AS id_a, b.id AS id_b, round(len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))), 6) AS jaccard FROM t a JOIN t b ON a.block = b.block AND a.id < b.id WHERE len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) >= 0.6""")
def jn19(spark, d):
    words = F.array_distinct(F.filter(F.split(F.lower(X.fold_accents("full_name")), "[^a-z]+"), lambda w: w != ""))
    block = F.lower(X.fold_accents(F.element_at(F.split(F.trim("full_name"), " "), -1)))
    rows = valid(spark, d, "contributors").where("full_name IS NOT NULL").select("id", words.alias("w"), block.alias("block"))
    # at this likeness names of a surname share a forename too, unless they have none: that is the join key
    keyed = rows.withColumn("others", F.filter("w", lambda x: x != F.col("block"))).withColumn("k", F.explode(F.when(F.size("others") > 0, F.col("others")).otherwise(F.array(F.lit("")))))
    a, b = keyed.select(F.col("id").alias("id_a"), F.col("w").alias("wa"), "block", "k"), keyed.select(F.col("id").alias("id_b"), F.col("w").alias("wb"), "block", "k")
    share = F.size(F.array_intersect("wa", "wb")) / F.size(F.array_union("wa", "wb"))
    return a.join(b, ["block", "k"]).where("id_a < id_b").where(share >= 0.6).select("id_a", "id_b", F.round(share, 6).alias("jaccard")).distinct()


@query("jn19_ratio_pairs")
def jn19_ratio(spark, d):
    """Pairs of contributors of one surname whose names are alike by longest matching blocks.

    Equal names are one class, scored once.  Two names may only be alike (0.85) if few letters of each are
    without a match, so the rarest letters before the surname are the join key: a name of ``n`` letters has
    at most ``6 n / 23`` unmatched, and one more than that must hold a shared one.  Nothing alike is lost.
    """
    from lexiloom.functions.similarity import rare_letters, ratio

    rows = valid(spark, d, "contributors").where("full_name IS NOT NULL").select("id", F.lower("full_name").alias("n"), F.lower(F.element_at(F.split(F.trim("full_name"), " "), -1)).alias("block"))
    size = F.length("n").alias("size")
    classes = rows.select("block", "n", size, F.endswith("n", F.col("block")).alias("plain")).distinct()
    rest = F.expr("left(n, length(n) - length(block))")
    letters = classes.where("plain").withColumn("letters", rare_letters(rest)).withColumn("most", F.expr("6 * size div 23").cast("int"))
    # a name that may share no letter at all has a key for that, the last
    keys = F.when(F.size("letters") <= F.col("most"), F.concat("letters", F.array(F.lit("")))).otherwise(F.slice("letters", 1, F.col("most") + 1))
    keyed = letters.withColumn("keys", keys).select("block", "n", "size", "letters", "keys", F.explode("keys").alias("k"))
    a, b = (keyed.select("block", "k", *[F.col(c).alias(f"{c}_{s}") for c in ("n", "size", "letters", "keys")]) for s in "ab")
    fits = F.expr("200 * least(size_a, size_b) >= 85 * (size_a + size_b)")
    bags = F.expr("200 * (length(block) + size(array_intersect(letters_a, letters_b))) >= 85 * (size_a + size_b)")
    first = F.element_at(F.array_intersect("keys_a", "keys_b"), 1) == F.col("k")
    near = a.join(b, ["block", "k"]).where(F.col("n_a") < F.col("n_b")).where(fits).where(first).where(bags).select("block", "n_a", "n_b")
    # names that do not end in their surname (spaces follow it) are compared with all of the block
    a, b = (classes.select("block", *[F.col(c).alias(f"{c}_{s}") for c in ("n", "size", "plain")]) for s in "ab")
    odd = a.where("NOT plain_a").join(b, "block").where(fits).where(F.col("plain_b") | (F.col("n_a") < F.col("n_b"))).select("block", "n_a", "n_b")
    # the ratio depends on which name comes first, that of the lesser id
    scored = near.unionByName(odd).withColumn("ab", ratio("n_a", "n_b")).withColumn("ba", ratio("n_b", "n_a")).where("ab >= 0.85 OR ba >= 0.85")
    equal = classes.select("block", F.col("n").alias("n_a"), F.col("n").alias("n_b"), F.lit(1.0).alias("ab"), F.lit(0.0).alias("ba"))
    x, y = (rows.select("block", F.col("id").alias(f"id_{s}"), F.col("n").alias(f"n_{s}")) for s in "ab")
    both = scored.unionByName(equal).join(x, ["block", "n_a"]).join(y, ["block", "n_b"]).where("id_a <> id_b")
    said = both.withColumn("ratio", F.expr("CASE WHEN id_a < id_b THEN ab ELSE ba END")).where("ratio >= 0.85")
    return said.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), F.round("ratio", 6).alias("ratio"))


def carried_sections(spark, d):
    """Every article with the last section named before it in its volume."""
    rows = valid(spark, d).select("id", "volume", "page_start", "section_name")
    return last_known(rows, ["volume"], ["page_start", "id"], F.col("section_name"), "carried").select("id", "carried")


query("jn7_carried_section", f"WITH {VA} SELECT id, last_value(section_name IGNORE NULLS) OVER (PARTITION BY volume ORDER BY page_start, id ROWS UNBOUNDED PRECEDING) AS carried FROM va")(carried_sections)
