"""Entity resolution, graphs, search, vectors and the audits on them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexiloom.functions import text as X
from lexiloom.functions import vectors as V
from lexiloom.operators import graph, ladder, resolve, search
from lexiloom.operators.components import connected_components
from lexiloom.operators.intervals import range_join
from lexiloom.operators.ordered import running_sum
from lexiloom.operators.sequence import greedy_bins
from lexiloom.operators.skew import left_join_unique
from lexiloom.plans.common import HEAD, REFS, VA, VC, Registry, head_key, once, valid
from lexiloom.plans.joins import _CREDITS, credits, refs, titles
from lexiloom.plans.joins import SQL as JOIN_SQL
from lexiloom.tables import table

query = Registry()
QUERIES, SQL = query.queries, query.sql
_T = "titles AS (SELECT DISTINCT upper(heading) AS title FROM headings)"
_NK = "array_to_string(list_sort(list_filter(regexp_split_to_array(lower(strip_accents({0})), '[^a-z]+'), lambda w: w <> '')), ' ')"


def name_key(c):
    return F.array_join(F.array_sort(F.filter(F.split(F.lower(X.fold_accents(c)), "[^a-z]+"), lambda w: w != "")), " ")


# --- picking -----------------------------------------------------------------------------------


_RS2 = f"WITH c AS (SELECT l.ref, l.title, l.rung, (h.category = 'biography') = contains(l.ref, ',') AS kind FROM ({JOIN_SQL['rs1_ladder']}) l JOIN headings h ON upper(h.heading) = l.title)"


@query("rs2_topic_resolve", _RS2 + """, e AS (SELECT ref, min(title) AS title FROM c WHERE rung = 'exact' GROUP BY ref HAVING count(*) = 1), k AS (SELECT ref, min(title) AS title FROM c WHERE kind AND ref NOT IN (SELECT ref FROM e) GROUP BY ref HAVING count(*) = 1),
r AS (SELECT *, min(length(title)) OVER (PARTITION BY ref) AS least FROM c WHERE ref NOT IN (SELECT ref FROM e) AND ref NOT IN (SELECT ref FROM k)), l AS (SELECT ref, min(title) AS title FROM r WHERE length(title) = least GROUP BY ref HAVING count(*) = 1)
SELECT ref, title, 'exact' AS method FROM e UNION ALL SELECT ref, title, 'kind' FROM k UNION ALL SELECT ref, title, 'length' FROM l UNION ALL SELECT DISTINCT ref, NULL, 'abstain' FROM r WHERE ref NOT IN (SELECT ref FROM l)""")
def rs2(spark, d):
    """Every reference through the ladder, then the pick by category and the least title."""
    rows = ladder.ladder(refs(spark, d), titles(spark, d)).join(table(spark, d, "headings").select(F.upper("heading").alias("title"), "category"), "title")
    person = F.when((F.col("category") == "biography") == F.col("ref").contains(","), 1.0)
    return resolve.fish(rows, "ref", "title", [("exact", (F.col("rung") == "exact").cast("double")), ("kind", person), ("length", 1000.0 - F.length("title"))])


@query("rs3_trusted_cuts", f"WITH {REFS}, {_T}, w AS (SELECT ref, string_split(ref, ' ') AS a FROM refs), c AS (SELECT ref, i, array_to_string(list_slice(a, i, len(a)), ' ') AS title FROM (SELECT ref, a, unnest(range(1, len(a) + 1)) AS i FROM w)) SELECT ref, min_by(title, i) AS title, min(i) AS cut FROM c JOIN titles USING (title) GROUP BY ref")
def rs3(spark, d):
    cuts = refs(spark, d).select("ref", F.posexplode(X.suffix_cuts(F.split("ref", " "))).alias("pos", "title"))
    return cuts.join(titles(spark, d), "title").groupBy("ref").agg(F.min_by("title", "pos").alias("title"), (F.min("pos") + 1).cast("bigint").alias("cut"))


@query("rs4_self_references", f"WITH {VA} SELECT DISTINCT x.id FROM xrefs x JOIN va ON va.id = x.article_id WHERE upper(trim(x.normalized_target)) = upper(va.title)")
def rs4(spark, d):
    owners = valid(spark, d).select(F.col("id").alias("article_id"), F.upper("title").alias("own"))
    return table(spark, d, "xrefs").join(owners, "article_id").where(F.upper(F.trim("normalized_target")) == F.col("own")).select("id").distinct()


@query("rs5_topic_gate", f"WITH {VA}, x AS (SELECT DISTINCT id, article_id, upper(trim(normalized_target)) AS t FROM xrefs WHERE xref_type IN ('see', 'see_also') AND normalized_target IS NOT NULL), c AS (SELECT x.id, h.heading_id FROM x JOIN headings h ON upper(h.heading) = x.t JOIN va ON va.id = x.article_id JOIN headings o ON upper(o.heading) = upper(va.title) WHERE o.category = h.category) SELECT id, min(heading_id) AS heading_id FROM c GROUP BY id HAVING count(DISTINCT heading_id) = 1")
def rs5(spark, d):
    h = table(spark, d, "headings")
    x = once(spark, d, "xrefs", "id", "article_id", "xref_type", "normalized_target").where("xref_type IN ('see', 'see_also')").select("id", "article_id", F.upper(F.trim("normalized_target")).alias("t"))
    own = valid(spark, d).select(F.col("id").alias("article_id"), F.upper("title").alias("k")).join(h.select(F.upper("heading").alias("k"), F.col("category").alias("own")), "k").select("article_id", "own")
    met = x.join(h.select(F.upper("heading").alias("t"), "heading_id", "category"), "t").join(own, "article_id").where("own = category")
    return resolve.only(met.select("id", "heading_id").distinct(), "id")


@query("rs6_person_tier", f"WITH {REFS}, p AS (SELECT heading_id, split_part(heading, ', ', 1) AS sur, string_split(split_part(heading, ', ', 2), ' ')[1] AS given FROM headings WHERE category = 'biography' AND contains(heading, ', ')), r AS (SELECT ref, string_split(ref, ' ')[-1] AS sur, string_split(ref, ' ')[1] AS given FROM refs WHERE contains(ref, ' ') AND NOT contains(ref, ',')) SELECT ref, min(heading_id) AS heading_id FROM r JOIN p USING (sur) WHERE r.given = p.given OR (length(trim(r.given, '.')) = 1 AND starts_with(p.given, trim(r.given, '.'))) GROUP BY ref HAVING count(*) = 1")
def rs6(spark, d):
    words = F.split("ref", " ")
    r = refs(spark, d).where(F.col("ref").contains(" ") & ~F.col("ref").contains(",")).select("ref", F.element_at(words, -1).alias("sur"), F.element_at(words, 1).alias("g"))
    p = table(spark, d, "headings").where("category = 'biography' AND heading LIKE '%, %'").select("heading_id", F.substring_index("heading", ", ", 1).alias("sur"), F.element_at(F.split(F.element_at(F.split("heading", ", "), 2), " "), 1).alias("given"))
    bare = F.trim(F.col("g"), F.lit("."))
    met = r.join(p, "sur").where((F.col("g") == F.col("given")) | ((F.length(bare) == 1) & F.col("given").startswith(bare)))
    return resolve.only(met.select("ref", "heading_id"), "ref")


@query("rs7_rulings_first", f"WITH {REFS}, {_T}, r AS (SELECT ref, title FROM refs LEFT JOIN titles ON title = ref), u AS (SELECT title AS ref, CASE WHEN length(title) % 2 = 0 THEN 'RULED ' || title ELSE '' END AS ruling FROM titles WHERE starts_with(title, 'C')) SELECT ref, CASE WHEN ruling IS NULL THEN title WHEN ruling = '' THEN NULL ELSE ruling END AS title FROM r LEFT JOIN u USING (ref)")
def rs7(spark, d):
    t = titles(spark, d)
    found = refs(spark, d).join(t.select(F.col("title").alias("ref"), "title"), "ref", "left")
    ruled = t.where(F.col("title").startswith("C")).select(F.col("title").alias("ref"), F.when(F.length("title") % 2 == 0, F.concat(F.lit("RULED "), "title")).otherwise("").alias("ruling"))
    return resolve.override(found, ruled, "ref", "title")


@query("rs8_tight_rungs", f"WITH {REFS}, {_T} SELECT ref, min(title) AS title FROM refs JOIN titles ON strip_accents(ref) = strip_accents(title) OR strip_accents(ref) = strip_accents(CASE WHEN contains(title, ', ') THEN substr(title, strpos(title, ', ') + 2) || ' ' || split_part(title, ', ', 1) END) GROUP BY ref HAVING count(DISTINCT title) = 1")
def rs8(spark, d):
    t = titles(spark, d)
    inverted = F.when(F.col("title").contains(", "), F.concat(F.expr("substring(title, instr(title, ', ') + 2)"), F.lit(" "), F.substring_index("title", ", ", 1)))
    keys = t.select("title", X.fold_accents("title").alias("k")).unionByName(t.select("title", X.fold_accents(inverted).alias("k"))).where("k IS NOT NULL")
    met = refs(spark, d).withColumn("k", X.fold_accents("ref")).join(keys, "k").select("ref", "title").distinct()
    return resolve.only(met, "ref")


@query("rs9_section_references", f"WITH {REFS}, {_T}, s AS (SELECT ref, trim(regexp_extract(ref, '^([^:#§]+)\\s*[:#§]', 1)) AS head, trim(regexp_extract(ref, '[:#§]\\s*(.+)$', 1)) AS section FROM refs WHERE regexp_matches(ref, '[:#§]')) SELECT ref, head AS title, section FROM s JOIN titles ON title = head WHERE section <> ''")
def rs9(spark, d):
    parts = refs(spark, d).where(F.col("ref").rlike("[:#§]")).select("ref", F.trim(F.regexp_extract("ref", r"^([^:#§]+)\s*[:#§]", 1)).alias("title"), F.trim(F.regexp_extract("ref", r"[:#§]\s*(.+)$", 1)).alias("section"))
    return parts.where("section <> ''").join(titles(spark, d), "title").select("ref", "title", "section")


@query("rs10_cosine_margin", "WITH s AS (SELECT a.vec_id AS q, b.vec_id AS c, round(list_dot_product(a.embedding, b.embedding) / (sqrt(list_dot_product(a.embedding, a.embedding)) * sqrt(list_dot_product(b.embedding, b.embedding))), 4) AS score FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, c) AS k FROM s), p AS (SELECT q, max(CASE WHEN k = 1 THEN c END) AS c, max(CASE WHEN k = 1 THEN score END) AS score, max(CASE WHEN k = 2 THEN score END) AS second FROM r GROUP BY q) SELECT q, c, score FROM p WHERE score >= 0.25 AND coalesce(score - second, 1) >= 0.01")
def rs10(spark, d):
    v = table(spark, d, "embeddings")
    q = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("e1"), "label")
    c = v.select(F.col("vec_id").alias("c"), F.col("embedding").alias("e2"), "label")
    scored = q.join(c, "label").where("q <> c").select("q", "c", F.round(V.cosine("e1", "e2"), 4).alias("score"))
    # vectors of these tables are less alike than those the pickers' own thresholds are for
    return resolve.best_by_margin(scored, "q", "c", "score", 0.25, 0.01)


@query("rs11_unique_kind", f"WITH {VA} SELECT upper(split_part(title, ',', 1)) AS ref, min(id) AS id FROM va WHERE article_type = 'article' AND NOT regexp_matches(title, '(?i),\\s*(BATTLE|TREATY|SIEGE)\\b') GROUP BY 1 HAVING count(*) = 1")
def rs11(spark, d):
    rows = valid(spark, d).select(F.upper(F.substring_index("title", ",", 1)).alias("ref"), "id", "article_type", "title")
    fits = (F.col("article_type") == "article") & ~F.col("title").rlike(r"(?i),\s*(BATTLE|TREATY|SIEGE)\b")
    return resolve.only(rows, "ref", fits).select("ref", "id")


@query("rs12_geo_filter", f"WITH {VA}, s AS (SELECT id, volume, (length(lower(substr(body, 1, 180))) - length(replace(lower(substr(body, 1, 180)), 'coast', ''))) / 5 + 0.5 * ((length(lower(substr(body, 1, 180))) - length(replace(lower(substr(body, 1, 180)), 'harbour', ''))) / 7) AS score FROM va), m AS (SELECT *, max(score) OVER (PARTITION BY volume) AS best FROM s) SELECT id, volume FROM m WHERE score = best AND score > 0")
def rs12(spark, d):
    head = F.lower(F.substring("body", 1, 180))
    scored = valid(spark, d).select("id", "volume", (X.occurrences(head, F.lit("coast")) + 0.5 * X.occurrences(head, F.lit("harbour"))).alias("score"))
    best = scored.groupBy("volume").agg(F.max("score").alias("best"))
    return scored.join(best, "volume").where("score = best AND score > 0").select("id", "volume")


@query("rs13_swapped_links", "WITH x AS (SELECT DISTINCT id, normalized_target AS t, trim(regexp_extract(surface_text, '\\|([^|»]*)»$', 1)) AS s FROM xrefs WHERE surface_text IS NOT NULL AND normalized_target IS NOT NULL), k AS (SELECT DISTINCT upper(heading) AS h FROM headings) SELECT id, CASE WHEN upper(t) NOT IN (SELECT h FROM k) AND upper(s) IN (SELECT h FROM k) THEN s ELSE t END AS t, upper(t) NOT IN (SELECT h FROM k) AND upper(s) IN (SELECT h FROM k) AS turned FROM x")
def rs13(spark, d):
    x = once(spark, d, "xrefs", "id", "surface_text", "normalized_target").where("surface_text IS NOT NULL AND normalized_target IS NOT NULL").select("id", F.col("normalized_target").alias("t"), F.trim(F.regexp_extract("surface_text", r"\|([^|»]*)»$", 1)).alias("s"))
    return resolve.swapped(x, "t", "s", table(spark, d, "headings").select(F.col("heading").alias("title"))).select("id", "t", "turned")


@query("rs14_bake_targets", "SELECT article_id, string_agg(t || '>' || f, ';' ORDER BY t) AS baked FROM (SELECT article_id, upper(trim(normalized_target)) AS t, min(target_article_id) AS f FROM xrefs WHERE status = 'resolved' AND article_id IS NOT NULL AND normalized_target IS NOT NULL AND target_article_id IS NOT NULL GROUP BY 1, 2) GROUP BY article_id")
def rs14(spark, d):
    live = table(spark, d, "xrefs").where("status = 'resolved' AND article_id IS NOT NULL AND normalized_target IS NOT NULL AND target_article_id IS NOT NULL")
    one = live.groupBy("article_id", F.upper(F.trim("normalized_target")).alias("t")).agg(F.min("target_article_id").alias("f"))
    return one.groupBy("article_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", "f"))), lambda p: F.concat(p["t"], F.lit(">"), p["f"].cast("string"))), ";").alias("baked"))


@query("rs15_resolve_signers", f"WITH {VC}, p AS (SELECT id, lower(strip_accents(string_split(trim(full_name), ' ')[-1])) AS sur, lower(strip_accents(string_split(trim(full_name), ' ')[1])) AS given FROM vc), e AS (SELECT DISTINCT id AS entry_id, lower(strip_accents(string_split(trim(full_name), ' ')[-1])) AS sur, lower(strip_accents(string_split(trim(full_name), ' ')[1])) AS given FROM vol29_entries WHERE full_name IS NOT NULL), s AS (SELECT entry_id, id, CASE WHEN e.given = p.given THEN 2 WHEN substr(e.given, 1, 1) = substr(p.given, 1, 1) AND (length(trim(e.given, '.')) = 1 OR length(trim(p.given, '.')) = 1) THEN 1 ELSE 0 END AS score FROM e JOIN p USING (sur)), m AS (SELECT *, max(score) OVER (PARTITION BY entry_id) AS best FROM s) SELECT entry_id, min(id) AS id FROM m WHERE score = best AND score > 0 GROUP BY entry_id HAVING count(*) = 1")
def rs15(spark, d):
    def parts(df, name):
        words = F.split(F.trim(name), " ")
        return df.withColumn("sur", F.lower(X.fold_accents(F.element_at(words, -1)))).withColumn("given", F.lower(X.fold_accents(F.element_at(words, 1))))

    p = parts(valid(spark, d, "contributors"), "full_name").select("id", "sur", F.col("given").alias("pg"))
    e = parts(table(spark, d, "vol29_entries").where("full_name IS NOT NULL"), "full_name").select(F.col("id").alias("entry_id"), "sur", "given").distinct()
    short = (F.length(F.trim("given", F.lit("."))) == 1) | (F.length(F.trim("pg", F.lit("."))) == 1)
    score = F.when(F.col("given") == F.col("pg"), 2).when((F.substring("given", 1, 1) == F.substring("pg", 1, 1)) & short, 1).otherwise(0)
    return resolve.fish(e.join(p, "sur"), "entry_id", "id", [("name", score)]).where("id IS NOT NULL").select("entry_id", "id")


_SIGNED = "s AS (SELECT DISTINCT contributor_id AS id, regexp_replace(upper(strip_accents(initials)), '[^A-Z]', '', 'g') AS k FROM contributor_initials WHERE initials IS NOT NULL)"


@query("rs16_signature_conflicts", "SELECT regexp_replace(upper(strip_accents(initials)), '[^A-Z]', '', 'g') AS signature, count(DISTINCT contributor_id) AS n FROM contributor_initials WHERE initials IS NOT NULL GROUP BY 1 HAVING count(DISTINCT contributor_id) > 1")
def rs16(spark, d):
    rows = table(spark, d, "contributor_initials").where("initials IS NOT NULL AND contributor_id IS NOT NULL").select(X.initials_key("initials").alias("signature"), "contributor_id").distinct()
    return rows.groupBy("signature").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("rs16_bind", f"""WITH {VC}, {_SIGNED}, c AS (SELECT DISTINCT article_id, contributor_id FROM article_contributors WHERE article_id IS NOT NULL), u AS (SELECT k, min(s.id) AS id FROM s JOIN vc ON vc.id = s.id WHERE k <> '' GROUP BY k HAVING count(DISTINCT s.id) = 1),
o AS (SELECT s.id AS contributor_id, min(u.id) AS id FROM s JOIN u USING (k) GROUP BY 1 HAVING count(DISTINCT u.id) = 1)
SELECT article_id, contributor_id AS credited, coalesce(vc.id, o.id) AS bound, CASE WHEN vc.id IS NOT NULL THEN 'roster' WHEN o.id IS NOT NULL THEN 'signature' WHEN contributor_id IS NULL THEN 'uncredited' ELSE 'unbound' END AS how FROM c LEFT JOIN vc ON vc.id = c.contributor_id LEFT JOIN o USING (contributor_id)""")
def rs16_bind(spark, d):
    """Every credit bound to a person who is there: by the roster, else by a signature that one person alone has."""
    credited = table(spark, d, "article_contributors").where("article_id IS NOT NULL").select("article_id", "contributor_id").distinct()
    roster = valid(spark, d, "contributors").select(F.col("id").alias("contributor_id"), F.col("id").alias("here"))
    signed = table(spark, d, "contributor_initials").where("initials IS NOT NULL").select("contributor_id", X.initials_key("initials").alias("k")).distinct()
    unique = signed.where("k <> ''").join(roster, "contributor_id").groupBy("k").agg(F.min("here").alias("owner"), F.max("here").alias("other")).where("owner = other").select("k", "owner")
    other = signed.join(unique, "k").groupBy("contributor_id").agg(F.min("owner").alias("owner"), F.max("owner").alias("m")).where("owner = m").select("contributor_id", "owner")
    how = F.when(F.col("here").isNotNull(), "roster").when(F.col("owner").isNotNull(), "signature").when(F.col("contributor_id").isNull(), "uncredited").otherwise("unbound")
    bound = left_join_unique(left_join_unique(credited, roster, "contributor_id"), other, "contributor_id")
    return bound.select("article_id", F.col("contributor_id").alias("credited"), F.coalesce("here", "owner").alias("bound"), how.alias("how"))


@query("rs17_roster_accretion", "WITH e AS (SELECT DISTINCT id, full_name, lower(strip_accents(string_split(trim(full_name), ' ')[-1])) || '|' || lower(strip_accents(substr(full_name, 1, 1))) AS k FROM vol29_entries WHERE full_name IS NOT NULL) SELECT k, max_by(full_name, (length(full_name), full_name)) AS full_name, count(*) AS n FROM e GROUP BY k")
def rs17(spark, d):
    key = F.concat(F.lower(X.fold_accents(F.element_at(F.split(F.trim("full_name"), " "), -1))), F.lit("|"), F.lower(X.fold_accents(F.substring("full_name", 1, 1))))
    rows = table(spark, d, "vol29_entries").where("full_name IS NOT NULL").select("id", "full_name", key.alias("k")).distinct()
    return rows.groupBy("k").agg(F.max_by("full_name", F.struct(F.length("full_name"), "full_name")).alias("full_name"), F.count(F.lit(1)).alias("n"))


@query("rs18_credit_pick", f"WITH {VA}, c AS ({_CREDITS}), m AS (SELECT DISTINCT credit_id, va.id FROM c JOIN va ON {HEAD.format('va.title')} = {HEAD.format('c.subject')} WHERE va.article_type = 'article' AND contains(va.title, ',') = contains(c.subject, ',')) SELECT credit_id, min(id) AS id FROM m GROUP BY credit_id HAVING count(*) = 1")
def rs18(spark, d):
    """The article of a credit's name where one alone is of the kind that the credit's form expects: persons are filed with a comma."""
    rows = valid(spark, d).where("article_type = 'article'").select("id", "title", head_key("title").alias("k"))
    met = credits(spark, d).withColumn("k", head_key("subject")).join(rows, "k").where(F.col("title").contains(",") == F.col("subject").contains(","))
    return resolve.only(met.select("credit_id", "id").distinct(), "credit_id")


@query("rs19_link_actions", f"WITH {VC}, e AS (SELECT DISTINCT id, {_NK.format('full_name')} AS k, regexp_replace(upper(initials), '[^A-Z]', '', 'g') AS s FROM vol29_entries), p AS (SELECT {_NK.format('full_name')} AS k, count(*) AS n, min(id) AS cid FROM vc GROUP BY 1), i AS (SELECT contributor_id, max(regexp_replace(upper(initials), '[^A-Z]', '', 'g')) AS s FROM contributor_initials GROUP BY 1) SELECT e.id, CASE WHEN e.k IS NULL OR e.k = '' THEN 'NEEDS_REVIEW' WHEN p.n IS NULL THEN 'INSERT' WHEN p.n > 1 THEN 'NEEDS_REVIEW' WHEN i.s IS NULL AND e.s IS NOT NULL THEN 'ADD_INITIALS' ELSE 'NO_OP' END AS action FROM e LEFT JOIN p ON p.k = e.k LEFT JOIN i ON i.contributor_id = p.cid")
def rs19(spark, d):
    e = table(spark, d, "vol29_entries").select("id", name_key("full_name").alias("k"), F.regexp_replace(F.upper("initials"), "[^A-Z]", "").alias("s")).distinct()
    p = valid(spark, d, "contributors").groupBy(name_key("full_name").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("contributor_id"))
    i = table(spark, d, "contributor_initials").groupBy("contributor_id").agg(F.max(F.regexp_replace(F.upper("initials"), "[^A-Z]", "")).alias("si"))
    action = F.when(F.col("k").isNull() | (F.col("k") == ""), "NEEDS_REVIEW").when(F.col("n").isNull(), "INSERT").when(F.col("n") > 1, "NEEDS_REVIEW").when(F.col("si").isNull() & F.col("s").isNotNull(), "ADD_INITIALS").otherwise("NO_OP")
    return e.join(p, "k", "left").join(i, "contributor_id", "left").select("id", action.alias("action"))


@query("rs20_merge_duplicates", f"WITH RECURSIVE {VC}, b AS (SELECT id, {_NK.format('full_name')} AS k, credentials FROM vc), e AS (SELECT a.id AS u, c.id AS v FROM b a JOIN b c ON a.k = c.k AND a.id <> c.id), r AS (SELECT id AS node, id AS root FROM b UNION SELECT r.node, e.v FROM r JOIN e ON e.u = r.root) SELECT root AS canonical, count(*) AS n FROM (SELECT node, min(root) AS root FROM r GROUP BY node) GROUP BY root HAVING count(*) > 1")
def rs20(spark, d):
    rows = valid(spark, d, "contributors").select("id", name_key("full_name").alias("k"))
    first = rows.groupBy("k").agg(F.min("id").alias("first"))
    edges = rows.join(first, "k").where("id <> first").select(F.col("id").alias("u"), F.col("first").alias("v"))
    return connected_components(edges).groupBy(F.col("component").alias("canonical")).agg(F.count(F.lit(1)).alias("n"))


_MERGED = f"{VC}, m AS (SELECT id, min(id) OVER (PARTITION BY {_NK.format('full_name')}) AS canonical FROM vc WHERE {_NK.format('full_name')} <> '')"


def _merged(spark, d):
    """Every contributor with a readable name and the record that its duplicates are merged into."""
    rows = valid(spark, d, "contributors").select("id", name_key("full_name").alias("k"), "credentials", "description").where("k <> ''")
    return rows.join(rows.groupBy("k").agg(F.min("id").alias("canonical")), "k")


@query("rs20_credits", f"WITH {_MERGED} SELECT a.article_id, coalesce(m.canonical, a.contributor_id) AS contributor_id, min(a.seq_no) AS seq_no FROM article_contributors a LEFT JOIN m ON m.id = a.contributor_id GROUP BY 1, 2")
def rs20_credits(spark, d):
    """Credits after the merge: moved to the record that stays, and once where both had one."""
    moved = left_join_unique(table(spark, d, "article_contributors").select("article_id", "contributor_id", "seq_no"), _merged(spark, d).select(F.col("id").alias("contributor_id"), "canonical"), "contributor_id")
    return moved.groupBy("article_id", F.coalesce("canonical", "contributor_id").alias("contributor_id")).agg(F.min("seq_no").alias("seq_no"))


@query("rs20_initials", f"WITH {_MERGED} SELECT coalesce(m.canonical, i.contributor_id) AS contributor_id, i.initials, min(i.id) AS id FROM contributor_initials i LEFT JOIN m ON m.id = i.contributor_id GROUP BY 1, 2")
def rs20_initials(spark, d):
    """Signatures after the merge, once for each notation."""
    moved = left_join_unique(table(spark, d, "contributor_initials").select("id", "contributor_id", "initials"), _merged(spark, d).select(F.col("id").alias("contributor_id"), "canonical"), "contributor_id")
    return moved.groupBy(F.coalesce("canonical", "contributor_id").alias("contributor_id"), "initials").agg(F.min("id").alias("id"))


@query("rs20_promoted", f"WITH {_MERGED} SELECT m.canonical AS id, coalesce(max(CASE WHEN m.id = m.canonical THEN vc.credentials END), min_by(vc.credentials, m.id) FILTER (vc.credentials IS NOT NULL)) AS credentials, coalesce(max(CASE WHEN m.id = m.canonical THEN vc.description END), min_by(vc.description, m.id) FILTER (vc.description IS NOT NULL)) AS description, count(*) AS n_records FROM m JOIN vc USING (id) GROUP BY 1")
def rs20_promoted(spark, d):
    """The records that stay; a field that is empty there is filled from the first of the others that has it."""
    def kept(c):
        own = F.max(F.when(F.col("id") == F.col("canonical"), F.col(c)))
        return F.coalesce(own, F.min_by(c, F.when(F.col(c).isNotNull(), F.col("id")))).alias(c)

    return _merged(spark, d).groupBy(F.col("canonical")).agg(kept("credentials"), kept("description"), F.count(F.lit(1)).alias("n_records")).withColumnRenamed("canonical", "id")


_BLOCKS = f"{VC}, n AS (SELECT id, lower(strip_accents(string_split(trim(full_name), ' ')[-1])) AS sur, substr(full_name, 1, 1) AS f, credentials FROM vc), k AS (SELECT sur, f, credentials, min(id) AS first_id, count(*) AS n FROM n WHERE sur IS NOT NULL GROUP BY ALL)"


def _credential_classes(spark, d):
    """Contributors by surname, first letter and credentials."""
    known = F.coalesce(F.concat(F.lit("="), "credentials"), F.lit(""))
    n = valid(spark, d, "contributors").select("id", F.lower(X.fold_accents(F.element_at(F.split(F.trim("full_name"), " "), -1))).alias("sur"), F.substring("full_name", 1, 1).alias("f"), known.alias("k"))
    return n.where("sur IS NOT NULL")


@query("rs21_dedup_gate", f"WITH {_BLOCKS} SELECT least(a.first_id, b.first_id) AS id_a, greatest(a.first_id, b.first_id) AS id_b FROM k a JOIN k b USING (sur, f) WHERE coalesce('=' || a.credentials, '') < coalesce('=' || b.credentials, '')")
def rs21(spark, d):
    """Candidates for a merge that nothing accounts for: the classes of a block that differ in credentials, each by its first record.

    What holds for the first records holds for all of their classes; ``rs21_class_members`` has those.
    """
    classes = _credential_classes(spark, d).groupBy("sur", "f", "k").agg(F.min("id").alias("first"))
    a, b = (classes.select("sur", "f", F.col("k").alias(f"k{s}"), F.col("first").alias(f"id_{s}")) for s in "ab")
    pairs = a.join(b, ["sur", "f"]).where("ka < kb")
    return pairs.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))


@query("rs21_class_members", f"WITH {_BLOCKS} SELECT n.id, k.first_id AS class_id FROM n JOIN k ON k.sur = n.sur AND k.f = n.f AND k.credentials IS NOT DISTINCT FROM n.credentials")
def rs21_members(spark, d):
    n = _credential_classes(spark, d)
    first = n.groupBy("sur", "f", "k").agg(F.min("id").alias("class_id"))
    return n.join(first, ["sur", "f", "k"]).select("id", "class_id")


@query("rs22_bio_articles", f"WITH {VA}, c AS (SELECT DISTINCT trim(subject) AS name FROM ({_CREDITS}) WHERE NOT contains(subject, ',') AND contains(trim(subject), ' ')) SELECT name, min(va.id) AS article_id FROM c JOIN va ON upper(strip_accents(va.title)) = upper(strip_accents(string_split(name, ' ')[-1] || ', ' || array_to_string(list_slice(string_split(name, ' '), 1, len(string_split(name, ' ')) - 1), ' '))) GROUP BY name")
def rs22(spark, d):
    """The biography of a person that a credit names in reading order."""
    words = F.split("name", " ")
    filed = F.concat(F.element_at(words, -1), F.lit(", "), F.array_join(F.slice(words, 1, F.size(words) - 1), " "))
    people = credits(spark, d).select(F.trim("subject").alias("name")).where(~F.col("name").contains(",") & F.col("name").contains(" ")).distinct().withColumn("k", F.upper(X.fold_accents(filed)))
    rows = valid(spark, d).select(F.col("id").alias("aid"), F.upper(X.fold_accents("title")).alias("k"))
    return people.join(rows, "k").groupBy("name").agg(F.min("aid").alias("article_id"))


def _tree(spark, d):
    """Regions, their nations, and the nations' suppliers as one tree."""
    r = table(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("name"))
    n = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.col("n_name").alias("name"))
    s = table(spark, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.concat(F.lit("n"), "s_nationkey").alias("parent"), F.col("s_name").alias("name"))
    return r.unionByName(n).unionByName(s)


_TREE = "t AS (SELECT 'r' || r_regionkey AS id, NULL AS parent, r_name AS name FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, s_name FROM supplier), f AS (SELECT id, parent, name, 0 AS depth, name AS path, id AS root FROM t WHERE parent IS NULL UNION ALL SELECT t.id, t.parent, t.name, f.depth + 1, f.path || '/' || t.name, f.root FROM t JOIN f ON t.parent = f.id)"


@query("rs23_topic_flatten", f"WITH RECURSIVE {_TREE} SELECT id, parent, name, depth, path, root FROM f")
def rs23(spark, d):
    return graph.flatten(_tree(spark, d))


@query("rs24_root_map", f"WITH RECURSIVE {_TREE} SELECT f.root, count(*) AS n_members FROM customer c JOIN f ON f.id = 'n' || c.c_nationkey GROUP BY f.root")
def rs24(spark, d):
    members = table(spark, d, "customer").select(F.concat(F.lit("n"), "c_nationkey").alias("node"))
    return graph.rollup(graph.flatten(_tree(spark, d)), members, "node")


_OUT = "o AS (SELECT DISTINCT id, volume, page_number * 1000000 + id AS at, CASE WHEN page_number % 7 = 1 THEN 0 WHEN page_number % 3 = 1 THEN 1 ELSE 2 END AS level FROM source_pages)"


@query("rs25_outline_parents", f"WITH {_OUT} SELECT x.id, max_by(p.id, p.at) AS parent FROM o x LEFT JOIN o p ON p.volume = x.volume AND p.at < x.at AND p.level < x.level AND NOT EXISTS (SELECT 1 FROM o q WHERE q.volume = x.volume AND q.at > p.at AND q.at < x.at AND q.level < x.level) GROUP BY x.id")
def rs25(spark, d):
    at = F.col("page_number").cast("bigint") * 1000000 + F.col("id")
    level = F.when(F.col("page_number") % 7 == 1, 0).when(F.col("page_number") % 3 == 1, 1).otherwise(2)
    rows = table(spark, d, "source_pages").select("id", "volume", at.alias("at"), level.alias("level")).distinct()
    return graph.parents_by_level(rows, ["volume"], "at", "level", "id").select("id", "parent")


_INDEX = f"l AS (SELECT heading_id, category, heading, {HEAD.format('heading')} AS k, regexp_replace(heading, '\\s*\\(.*\\)|,.*$', '', 'g') AS head FROM headings WHERE category IS NOT NULL AND heading IS NOT NULL), g AS (SELECT category, k, min(head) AS head FROM l GROUP BY 1, 2 HAVING count(*) > 1)"


@query("rs25_index_tree", f"WITH {_INDEX} SELECT DISTINCT category AS path, NULL AS parent, 0 AS level FROM l UNION ALL SELECT category || '/' || head, category, 1 FROM g UNION ALL SELECT l.category || coalesce('/' || g.head, '') || '/' || l.heading, l.category || coalesce('/' || g.head, ''), CASE WHEN g.k IS NULL THEN 1 ELSE 2 END FROM l LEFT JOIN g ON g.category = l.category AND g.k = l.k")
def rs25_index_tree(spark, d):
    """The list of headings as a tree: categories, sections of entries that share their head (merged under its least spelling), and the entries, each seated in its section."""
    lines = table(spark, d, "headings").where("category IS NOT NULL AND heading IS NOT NULL").select("category", "heading", head_key("heading").alias("k"), F.regexp_replace("heading", r"\s*\(.*\)|,.*$", "").alias("head"))
    sections = lines.groupBy("category", "k").agg(F.min("head").alias("section"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    tops = lines.select(F.col("category").alias("path"), F.lit(None).cast("string").alias("parent"), F.lit(0).alias("level")).distinct()
    inner = sections.select(F.concat_ws("/", "category", "section").alias("path"), F.col("category").alias("parent"), F.lit(1).alias("level"))
    seat = F.concat_ws("/", "category", "section")
    leaves = lines.join(sections, ["category", "k"], "left").select(F.concat_ws("/", seat, "heading").alias("path"), seat.alias("parent"), F.when(F.col("section").isNull(), 1).otherwise(2).alias("level"))
    return tops.unionByName(inner).unionByName(leaves)


@query("rs26_note_pointers", f"WITH p AS (SELECT DISTINCT id, {HEAD.format('normalized_target')} AS k, contains(normalized_target, ',') AS person FROM xrefs WHERE xref_type IN ('see', 'see_also') AND normalized_target IS NOT NULL), h AS (SELECT heading_id, {HEAD.format('heading')} AS k, category = 'biography' AS person FROM headings), c AS (SELECT p.id, h.heading_id, h.person = p.person AS same, count(*) OVER (PARTITION BY p.id) AS n, count(*) FILTER (h.person = p.person) OVER (PARTITION BY p.id) AS m FROM p JOIN h USING (k)) SELECT id, heading_id FROM c WHERE (m = 1 AND same) OR (m <> 1 AND n = 1)")
def rs26(spark, d):
    """Where a *see* points: to the one heading of its name and kind, else to the one of its name."""
    p = table(spark, d, "xrefs").where("xref_type IN ('see', 'see_also') AND normalized_target IS NOT NULL").select("id", head_key("normalized_target").alias("k"), F.col("normalized_target").contains(",").alias("person")).distinct()
    h = table(spark, d, "headings").select("heading_id", head_key("heading").alias("k"), (F.col("category") == "biography").alias("is_person"))
    w = Window.partitionBy("id")
    met = p.join(h, "k").withColumn("same", F.col("person") == F.col("is_person")).withColumn("n", F.count(F.lit(1)).over(w)).withColumn("m", F.count_if("same").over(w))
    return met.where("(m = 1 AND same) OR (m <> 1 AND n = 1)").select("id", "heading_id")


@query("rs27_ambiguities", f"SELECT {HEAD.format('heading')} AS k, count(*) AS n, string_agg(CAST(heading_id AS VARCHAR), ',' ORDER BY heading_id) AS ids FROM headings GROUP BY 1 HAVING count(*) > 1")
def rs27(spark, d):
    rows = table(spark, d, "headings").groupBy(head_key("heading").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("heading_id")).alias("i")).where("n > 1")
    return rows.select("k", "n", F.array_join(F.transform("i", lambda x: x.cast("string")), ",").alias("ids"))


@query("rs28_edge_degrees", "WITH e AS (SELECT DISTINCT article_id AS s, target_article_id AS t FROM xrefs WHERE article_id IS NOT NULL AND target_article_id IS NOT NULL), b AS (SELECT s AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT t, 0, 1 FROM e) SELECT node, sum(o)::BIGINT AS n_out, sum(i)::BIGINT AS n_in FROM b GROUP BY node")
def rs28(spark, d):
    edges = table(spark, d, "xrefs").where("article_id IS NOT NULL AND target_article_id IS NOT NULL").select("article_id", "target_article_id").distinct()
    return graph.degrees(edges, "article_id", "target_article_id")


# --- search ------------------------------------------------------------------------------------

_TERMS = "t AS (SELECT doc_id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(strip_accents(text)), '[^a-z0-9]+'), lambda w: w <> ''))) AS term FROM documents)"


@query("ft1_inverted_index", f"WITH {_TERMS} SELECT term, 0 AS part, count(*) AS n, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS docs FROM t GROUP BY term")
def ft1(spark, d):
    """Postings in parts of at most about 100,000 documents; the SQL has the first part, which is all below that."""
    index = search.index(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")
    return index.select("term", "part", "n", F.array_join(F.transform("docs", lambda x: x.cast("string")), ",").alias("docs"))


@query("ft1_df_cap", f"WITH {_TERMS}, n AS (SELECT count(*) AS n FROM documents) SELECT term, count(*) AS n, count(*) > greatest(200, 0.27 * (SELECT n FROM n)) AS ignored FROM t GROUP BY term")
def ft1_cap(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return search.frequent(search.terms(docs, "doc_id", "text"), docs.count())


@query("se5_and_query", f"WITH {_TERMS} SELECT doc_id FROM t WHERE term IN ('abbey', 'copper', 'country') GROUP BY 1 HAVING count(*) = 3")
def se5(spark, d):
    return search.all_terms(search.terms(table(spark, d, "documents"), "doc_id", "text"), "doc_id", ["abbey", "copper", "country"])


_ASKED = ("harbour", 'copper vol:2', 'by:john', 'abbey by:"john" vol:3', "the saint")
_FT2 = f"WITH {VA}, {VC}, w AS (SELECT DISTINCT a.article_id AS id, ' ' || regexp_replace(lower(strip_accents(vc.full_name)), '[^a-z]+', ' ', 'g') || ' ' AS name FROM article_contributors a JOIN vc ON vc.id = a.contributor_id), t AS (SELECT id, volume, lower(strip_accents(concat_ws(' ', title, body))) AS t FROM va WHERE article_type IS DISTINCT FROM 'plate')"


@query("ft2_filtered_search", f"""{_FT2} SELECT 'harbour' AS question, id FROM t WHERE contains(t, 'harbour') UNION ALL SELECT 'copper vol:2', id FROM t WHERE volume = 2 AND contains(t, 'copper')
UNION ALL SELECT 'by:john', id FROM t WHERE id IN (SELECT id FROM w WHERE contains(name, ' john ')) UNION ALL SELECT 'abbey by:"john" vol:3', id FROM t WHERE volume = 3 AND contains(t, 'abbey') AND id IN (SELECT id FROM w WHERE contains(name, ' john '))
UNION ALL SELECT 'the saint', id FROM t WHERE contains(t, 'the') AND contains(t, 'saint')""")
def ft2(spark, d):
    """What some questions with filters find."""
    names = valid(spark, d, "contributors").select(F.col("id").alias("contributor_id"), "full_name")
    authors = table(spark, d, "article_contributors").join(names, "contributor_id").select(F.col("article_id").alias("id"), "full_name")
    out = None
    for question in _ASKED:
        hits = search.ask(valid(spark, d), authors, question).select(F.lit(question).alias("question"), "id")
        out = hits if out is None else out.unionByName(hits)
    return out


@query("so8_ranked_search", f"""WITH {VA}, f AS (SELECT id, title, lower(strip_accents(title)) AS t, lower(strip_accents(body)) AS b, ' ' || regexp_replace(lower(strip_accents(title)), '[^a-z0-9]+', ' ', 'g') || ' ' AS w FROM va)
SELECT id, title, CASE WHEN t = 'saint' THEN 0 WHEN starts_with(w, ' saint ') THEN 1 WHEN starts_with(t, 'saint') THEN 2 WHEN contains(w, ' saint ') THEN 3 WHEN contains(t, 'saint') THEN 4 ELSE 5 END AS tier, CAST((length(b) - length(replace(b, 'saint', ''))) / 5 AS INT) AS matches FROM f WHERE contains(t, 'saint') OR contains(b, 'saint')""")
def so8(spark, d):
    return search.ranked(valid(spark, d), "id", "title", "body", "Saint")


@query("ma7_deltas", f"WITH {_TERMS} SELECT term, doc_id, coalesce(doc_id - lag(doc_id) OVER (PARTITION BY term ORDER BY doc_id) - 1, doc_id) AS gap FROM t")
def ma7(spark, d):
    return search.deltas(search.terms(table(spark, d, "documents"), "doc_id", "text"), "doc_id")


@query("ma7_postings")
def ma7_postings(spark, d):
    """The postings of every term as text, in parts of a bounded number of documents that follow each other; a part's first gap counts from 0."""
    @F.pandas_udf("string")
    def encode(lists: pd.Series) -> pd.Series:
        return lists.map(lambda ids: "".join(search.varint(int(b - a - 1) if a >= 0 else int(b)) for a, b in zip([-1, *ids], ids)))

    chunk = 100_000
    placed = running_sum(search.terms(table(spark, d, "documents"), "doc_id", "text").withColumn("one", F.lit(1)), ["term"], ["doc_id"], "one", "before")
    parts = placed.groupBy("term", F.floor(F.col("before") / chunk).alias("part")).agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    return parts.select("term", "part", encode("ids").alias("postings"))


# --- vectors and scores ------------------------------------------------------------------------


@query("ma1_cosine", "SELECT a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.embedding, b.embedding) / (sqrt(list_dot_product(a.embedding, a.embedding)) * sqrt(list_dot_product(b.embedding, b.embedding))), 3) AS cosine FROM embeddings a JOIN embeddings b ON a.label = b.label AND b.vec_id = a.vec_id + 1")
def ma1(spark, d):
    v = table(spark, d, "embeddings")
    a = v.select(F.col("vec_id").alias("a"), (F.col("vec_id") + 1).alias("b"), F.col("embedding").alias("e1"), "label")
    b = v.select(F.col("vec_id").alias("b"), F.col("embedding").alias("e2"), "label")
    return a.join(b, ["b", "label"]).select("a", "b", F.round(V.cosine("e1", "e2"), 3).alias("cosine"))


@query("ma2_centroids", """WITH u AS (SELECT label, list_transform(embedding, lambda x: x / sqrt(list_dot_product(embedding, embedding))) AS u FROM embeddings WHERE list_dot_product(embedding, embedding) > 0), s AS (SELECT label, pos, sum(x) AS s FROM (SELECT label, unnest(u) AS x, unnest(range(0, len(u))) AS pos FROM u) GROUP BY 1, 2),
n AS (SELECT label, sqrt(sum(s * s)) AS n FROM s GROUP BY 1) SELECT label, CAST(pos AS INT) AS pos, round(s / n, 4) AS x FROM s JOIN n USING (label)""")
def ma2(spark, d):
    """The mean direction of the vectors of each label, place by place: sums of the unit vectors, at length 1."""
    unit = table(spark, d, "embeddings").select("label", F.posexplode(V.unit("embedding")).alias("pos", "x"))
    sums = unit.groupBy("label", "pos").agg(F.sum("x").alias("s"))
    length = sums.groupBy("label").agg(F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("n"))
    return sums.join(length, "label").select("label", "pos", F.round(F.col("s") / F.col("n"), 4).alias("x"))


@query("ma3_hashed_vectors")
def ma3(spark, d):
    """A vector of 64 places for every document by hashing its words; a stand-in for a trained embedding."""
    words = search.terms(table(spark, d, "documents"), "doc_id", "text")
    placed = words.groupBy("doc_id", F.pmod(F.xxhash64("term"), F.lit(64)).alias("pos")).agg(F.sum(F.when(F.xxhash64(F.lit(1), "term") % 2 == 0, 1.0).otherwise(-1.0)).alias("x"))
    return placed.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("pos", "x")))).alias("m")).select("doc_id", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("m", i.cast("bigint")), F.lit(0.0))).alias("vector"))


@query("ma4_path_weights", "SELECT n_nationkey AS id, round(3 * length(n_name) + 2 * length(r_name), 6) AS weight FROM nation JOIN region ON r_regionkey = n_regionkey")
def ma4(spark, d):
    path = table(spark, d, "nation").join(table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey")).select("n_nationkey", F.array("r_name", "n_name").alias("path"))
    weights = F.array(*[F.lit(w) for w in (3.0, 2.0, 1.3, 1.0, 0.8, 0.6)])
    total = F.aggregate(F.zip_with(F.reverse("path"), F.slice(weights, 1, F.size("path")), lambda p, w: F.length(p) * w), F.lit(0.0), lambda a, x: a + x)
    return path.select(F.col("n_nationkey").alias("id"), F.round(total, 6).alias("weight"))


@query("ma5_lead_scores", f"WITH {VA} SELECT id, 2.0 * ((length(h) - length(replace(h, 'coast', ''))) // 5) + 1.0 * ((length(h) - length(replace(h, 'river', ''))) // 5) AS score FROM (SELECT id, lower(substr(body, 1, 200)) AS h FROM va)")
def ma5(spark, d):
    head = F.lower(F.substring("body", 1, 200))
    return valid(spark, d).select("id", (2.0 * X.occurrences(head, F.lit("coast")) + 1.0 * X.occurrences(head, F.lit("river"))).alias("score"))


@query("ma6_footprint_score", f"WITH {VA}, b AS (SELECT DISTINCT contributor_id, article_id FROM article_contributors WHERE contributor_id IS NOT NULL), p AS (SELECT b.contributor_id, va.id, va.volume, va.page_start FROM b JOIN va ON va.id = b.article_id) SELECT x.contributor_id, x.id, sum(5 - abs(x.page_start - y.page_start))::BIGINT AS score FROM p x JOIN p y ON x.contributor_id = y.contributor_id AND x.volume = y.volume AND x.id <> y.id AND abs(x.page_start - y.page_start) < 5 GROUP BY 1, 2")
def ma6(spark, d):
    """How near each article of a contributor is to the contributor's others: only pages within five are joined, by cells."""
    rows = valid(spark, d).select(F.col("id").alias("article_id"), "volume", "page_start")
    p = table(spark, d, "article_contributors").where("contributor_id IS NOT NULL").select("contributor_id", "article_id").distinct().join(rows, "article_id")
    x = p.withColumn("low", F.col("page_start") - 4).withColumn("high", F.col("page_start") + 4)
    y = p.select("contributor_id", "volume", F.col("article_id").alias("other"), F.col("page_start").alias("there"))
    near = range_join(x, y, ["contributor_id", "volume"], "low", "high", "there", 8).where("article_id <> other")
    return near.groupBy("contributor_id", F.col("article_id").alias("id")).agg(F.sum(5 - F.abs(F.col("page_start") - F.col("there"))).alias("score"))


@query("ma8_digest_lookup", "WITH c AS (SELECT substr(sha256(heading), 1, 16) AS k, min(length(heading)) AS hint FROM headings GROUP BY 1) SELECT x.t, c.hint FROM (SELECT DISTINCT upper(normalized_target) AS t FROM xrefs WHERE normalized_target IS NOT NULL) x LEFT JOIN c ON c.k = substr(sha256(x.t), 1, 16)")
def ma8(spark, d):
    hints = table(spark, d, "headings").groupBy(X.digest("heading").alias("k")).agg(F.min(F.length("heading")).alias("hint"))
    t = table(spark, d, "xrefs").where("normalized_target IS NOT NULL").select(F.upper("normalized_target").alias("t")).distinct()
    return t.withColumn("k", X.digest("t")).join(hints, "k", "left").select("t", F.col("hint").cast("bigint").alias("hint"))


@query("ma9_crop_names", "SELECT DISTINCT id, 'crop_' || substr(md5(concat_ws('|', source_name, volume, page_number, 590)), 1, 10) || '.png' AS file FROM source_pages")
def ma9(spark, d):
    key = F.concat_ws("|", "source_name", F.col("volume").cast("string"), F.col("page_number").cast("string"), F.lit("590"))
    return table(spark, d, "source_pages").select("id", F.concat(F.lit("crop_"), F.substring(F.md5(key), 1, 10), F.lit(".png")).alias("file")).distinct()


@query("ma10_path_slugs", f"WITH RECURSIVE {_TREE} SELECT id, array_to_string(list_transform(string_split(path, '/'), lambda p: trim(regexp_replace(lower(p), '[^a-z0-9]+', '-', 'g'), '-')), '/') AS slug FROM f WHERE depth < 2")
def ma10(spark, d):
    return graph.flatten(_tree(spark, d)).where("depth < 2").select("id", F.array_join(F.transform(F.split("path", "/"), X.slug), "/").alias("slug"))


@query("ma11_collision_keys", f"SELECT {HEAD.format('heading')} || '|' || string_agg(heading, ',' ORDER BY heading) AS k FROM headings GROUP BY {HEAD.format('heading')} HAVING count(*) > 1")
def ma11(spark, d):
    g = table(spark, d, "headings").groupBy(head_key("heading").alias("t")).agg(F.array_sort(F.collect_list("heading")).alias("c")).where(F.size("c") > 1)
    return g.select(F.concat_ws("|", "t", F.array_join("c", ",")).alias("k"))


@query("ma12_payload_json", f"WITH {VA} SELECT id, sha256(title || '|' || volume || '|' || page_start) AS h FROM va")
def ma12(spark, d):
    made = valid(spark, d).select("id", F.to_json(F.struct("title", "volume", "page_start")).alias("j"))
    back = made.select("id", F.from_json("j", "title string, volume int, page_start int").alias("p"))
    return back.select("id", F.sha2(F.concat_ws("|", "p.title", F.col("p.volume").cast("string"), F.col("p.page_start").cast("string")), 256).alias("h"))


@query("ma13_coordinates", "SELECT s_suppkey AS id, CAST(s_suppkey % 90 AS VARCHAR) || '°' || CAST(s_suppkey % 60 AS VARCHAR) || '′N' AS place FROM supplier")
def ma13(spark, d):
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.concat((F.col("s_suppkey") % 90).cast("string"), F.lit("°"), (F.col("s_suppkey") % 60).cast("string"), F.lit("′N")).alias("place"))


@query("pk1_greedy_chunks", f"""WITH RECURSIVE {VA}, s AS (SELECT volume, id, length(body) AS n, row_number() OVER (PARTITION BY volume ORDER BY page_start, id) AS i FROM va),
w AS (SELECT volume, id, i, 0 AS bin, n AS used FROM s WHERE i = 1 UNION ALL SELECT s.volume, s.id, s.i, CASE WHEN w.used > 0 AND w.used + s.n > 100000 THEN w.bin + 1 ELSE w.bin END, CASE WHEN w.used > 0 AND w.used + s.n > 100000 THEN s.n ELSE w.used + s.n END FROM w JOIN s ON s.volume = w.volume AND s.i = w.i + 1) SELECT id, bin FROM w""")
def pk1(spark, d):
    """Articles of each volume in order, in chunks of about 100,000 characters."""
    rows = valid(spark, d).select("volume", "id", "page_start", F.length("body").alias("size"))
    rows = rows.withColumn("at", F.col("page_start").cast("bigint") * 100_000_000_000 + F.col("id"))
    return greedy_bins(rows, "volume", "at", "size", 100_000, "volume int, id bigint, page_start int, size int, at bigint, bin int").select("id", "bin")


@query("pk1_running_chunks", f"WITH {VA} SELECT id, CAST(floor(coalesce(sum(length(body)) OVER (PARTITION BY volume ORDER BY page_start, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 50000) AS BIGINT) AS chunk FROM va")
def pk1_running(spark, d):
    rows = valid(spark, d).select("id", "volume", "page_start", F.length("body").alias("size"))
    return graph.pack(rows, ["volume"], F.struct("page_start", "id"), "size", 50000).select("id", "chunk")


# --- supporting operators ----------------------------------------------------------------------


@query("xa1_leads", f"WITH {VA} SELECT id, coalesce(nullif(trim(substr(body, 1, 80)), ''), title) AS lead FROM va WHERE article_type = 'article'")
def xa1(spark, d):
    return valid(spark, d).where("article_type = 'article'").select("id", F.coalesce(F.nullif(F.trim(F.substring("body", 1, 80)), F.lit("")), "title").alias("lead"))


@query("xa2_printed_pages", "SELECT DISTINCT id, coalesce(TRY_CAST(nullif(regexp_extract(wikitext, 'Heading\\|[^|]*\\|[^|]*\\|(\\d{1,3})\\}\\}', 1), '') AS INT), TRY_CAST(nullif(regexp_extract(wikitext, '\\{\\{rh\\|(\\d{1,3})\\|', 1), '') AS INT), TRY_CAST(nullif(regexp_extract(raw_text, '(?m)^\\s*(\\d{1,3})\\s{2,}[A-Z]', 1), '') AS INT)) AS printed FROM source_pages")
def xa2(spark, d):
    ladder_ = [("wikitext", r"Heading\|[^|]*\|[^|]*\|(\d{1,3})\}\}"), ("wikitext", r"\{\{rh\|(\d{1,3})\|"), ("raw_text", r"(?m)^\s*(\d{1,3})\s{2,}[A-Z]")]
    return table(spark, d, "source_pages").select("id", F.coalesce(*[F.nullif(F.regexp_extract(c, p, 1), F.lit("")).try_cast("int") for c, p in ladder_]).alias("printed")).distinct()


@query("xa3_alias_harvest", f"WITH {VA}, m AS (SELECT unnest(regexp_extract_all(body, '«LN:([^«»]*)', 1)) AS m FROM va UNION ALL SELECT unnest(regexp_extract_all(surface_text, '«[AL][LN]:([^«»]*)', 1)) FROM xrefs) SELECT DISTINCT trim(split_part(m, '|', 1)) AS target, trim(split_part(m, '|', 2)) AS display FROM m WHERE contains(m, '|') AND trim(split_part(m, '|', 1)) <> trim(split_part(m, '|', 2)) AND length(split_part(m, '|', 2)) <= 50")
def xa3(spark, d):
    """What links show that is not what they point to, in the bodies and in the references' own marks."""
    inside = valid(spark, d).select(F.explode(F.regexp_extract_all("body", F.lit("«LN:([^«»]*)"), F.lit(1))).alias("m"))
    marks = table(spark, d, "xrefs").select(F.explode(F.regexp_extract_all("surface_text", F.lit("«[AL][LN]:([^«»]*)"), F.lit(1))).alias("m"))
    m = inside.unionByName(marks).where(F.col("m").contains("|"))
    parts = m.select(F.trim(F.split_part("m", F.lit("|"), F.lit(1))).alias("target"), F.split_part("m", F.lit("|"), F.lit(2)).alias("d"))
    return parts.where(F.length("d") <= 50).select("target", F.trim("d").alias("display")).where("target <> display").distinct()


@query("xa4_alias_insert", "WITH k AS (SELECT DISTINCT upper(heading) AS k FROM headings) SELECT upper(display) AS alias, min(id) AS id FROM vol29_entries WHERE upper(display) NOT IN (SELECT k FROM k) GROUP BY 1")
def xa4(spark, d):
    known = table(spark, d, "headings").select(F.upper("heading").alias("alias")).distinct()
    return table(spark, d, "vol29_entries").select(F.upper("display").alias("alias"), "id").join(known, "alias", "left_anti").groupBy("alias").agg(F.min("id").alias("id"))


@query("xa6_title_index", f"WITH {VA} SELECT upper(trim(title)) AS k, min_by(id, (volume, page_start, id)) AS id FROM va WHERE article_type IS DISTINCT FROM 'plate' GROUP BY 1")
def xa6(spark, d):
    rows = valid(spark, d).where("article_type IS NULL OR article_type <> 'plate'").withColumn("k", F.upper(F.trim("title")))
    return rows.groupBy("k").agg(F.min_by("id", F.struct("volume", "page_start", "id")).alias("id"))


@query("xa7_bio_backfill", f"WITH {VC}, b AS (SELECT {_NK.format('full_name')} AS k, max_by(description, (length(description), description)) AS best FROM vc WHERE description IS NOT NULL GROUP BY 1) SELECT vc.id, coalesce(vc.description, b.best) AS description FROM vc LEFT JOIN b ON b.k = {_NK.format('vc.full_name')}")
def xa7(spark, d):
    people = valid(spark, d, "contributors").withColumn("k", name_key("full_name"))
    best = people.where("description IS NOT NULL").groupBy("k").agg(F.max_by("description", F.struct(F.length("description"), "description")).alias("best"))
    return people.join(best, "k", "left").select("id", F.coalesce("description", "best").alias("description"))


@query("xa9_subject_variants", "SELECT DISTINCT heading, unnest(list_distinct([heading, trim(regexp_replace(heading, '\\s*\\([^()]*\\)', '')), split_part(heading, ',', 1)])) AS variant FROM headings")
def xa9(spark, d):
    v = F.array_distinct(F.array("heading", F.trim(F.regexp_replace("heading", r"\s*\([^()]*\)", "")), F.substring_index("heading", ",", 1)))
    return table(spark, d, "headings").select("heading", F.explode(v).alias("variant")).distinct()


@query("xa10_initials_groups", "SELECT regexp_replace(upper(initials), '[^A-Z]', '', 'g') AS s, count(DISTINCT id) AS n FROM vol29_entries WHERE initials IS NOT NULL GROUP BY 1 HAVING count(DISTINCT id) > 1")
def xa10(spark, d):
    return table(spark, d, "vol29_entries").where("initials IS NOT NULL").select(F.regexp_replace(F.upper("initials"), "[^A-Z]", "").alias("s"), "id").distinct().groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("xa11_credit_lists", "SELECT DISTINCT id, trim(unnest(articles)) AS article FROM vol29_entries")
def xa11(spark, d):
    return table(spark, d, "vol29_entries").select("id", F.explode("articles").alias("a")).select("id", F.trim("a").alias("article")).distinct()


#: Name variants: the whole name, and the surname after initials or a forename.
_NAMED = "[A-Z][\\p{L}.-]*(?: [A-Z][\\p{L}.-]*)* ([A-Z][\\p{L}-]{3,})"


@query("xa12_mentions", f"WITH {VC}, {VA}, n AS (SELECT upper(strip_accents(string_split(trim(full_name), ' ')[-1])) AS s, upper(substr(trim(full_name), 1, 1)) AS f FROM vc WHERE full_name IS NOT NULL UNION SELECT upper(strip_accents(split_part(title, ', ', 1))), upper(substr(split_part(title, ', ', 2), 1, 1)) FROM va WHERE contains(title, ', ')), t AS (SELECT 'document' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'reference', id, surface_text FROM xrefs), w AS (SELECT DISTINCT kind, id, unnest(regexp_extract_all(text, '{_NAMED.replace(chr(92) * 2, chr(92))}')) AS said FROM t) SELECT DISTINCT w.kind, w.id, w.said FROM w JOIN n ON n.s = upper(strip_accents(string_split(w.said, ' ')[-1])) AND n.f = upper(substr(w.said, 1, 1))")
def xa12(spark, d):
    """Names in the documents and references that may mean a contributor or the subject of a biography: same surname and first initial."""
    people = valid(spark, d, "contributors").where("full_name IS NOT NULL").select(F.element_at(F.split(F.trim("full_name"), " "), -1).alias("s"), F.substring(F.trim("full_name"), 1, 1).alias("f"))
    filed = valid(spark, d).where(F.col("title").contains(", ")).select(F.split_part("title", F.lit(", "), F.lit(1)).alias("s"), F.substring(F.split_part("title", F.lit(", "), F.lit(2)), 1, 1).alias("f"))
    names = people.unionByName(filed).select(F.upper(X.fold_accents("s")).alias("s"), F.upper("f").alias("f")).distinct()
    texts = table(spark, d, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text").unionByName(table(spark, d, "xrefs").select(F.lit("reference").alias("kind"), "id", F.col("surface_text").alias("text")))
    said = texts.select("kind", "id", F.explode(F.regexp_extract_all("text", F.lit(_NAMED.replace("\\\\", "\\")), F.lit(0))).alias("said")).distinct()
    said = said.withColumn("s", F.upper(X.fold_accents(F.element_at(F.split("said", " "), -1)))).withColumn("f", F.upper(F.substring("said", 1, 1)))
    return said.join(names, ["s", "f"]).select("kind", "id", "said").distinct()


@query("xa29_rule_scan", "WITH r AS (SELECT * FROM (VALUES ('double space', '  '), ('figure', 'Fig\\. '), ('see', '\\(see ')) AS v(rule, pattern)) SELECT rule, count(*) AS n FROM documents, r WHERE regexp_matches(text, pattern) GROUP BY rule")
def xa29(spark, d):
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(p).alias("pattern")) for n, p in (("double space", "  "), ("figure", r"Fig\. "), ("see", r"\(see "))])
    return table(spark, d, "documents").select("text", F.explode(rules).alias("r")).where(F.expr("text RLIKE r.pattern")).groupBy(F.col("r.rule").alias("rule")).agg(F.count(F.lit(1)).alias("n"))


@query("xa30_block_anchoring", f"WITH {VA} SELECT id, len(list_filter(string_split(body, chr(10) || chr(10)), lambda p: starts_with(ltrim(p), '«'))) AS marked FROM va")
def xa30(spark, d):
    return valid(spark, d).select("id", F.size(F.filter(F.split("body", "\n\n"), lambda p: F.ltrim(p).startswith("«"))).cast("bigint").alias("marked"))


@query("xa31_residual_sections", f"WITH {VA} SELECT DISTINCT volume, section_name FROM va WHERE section_name IS NOT NULL AND section_name NOT IN (SELECT target_section FROM xrefs WHERE target_section IS NOT NULL)")
def xa31(spark, d):
    used = table(spark, d, "xrefs").where("target_section IS NOT NULL").select(F.col("target_section").alias("section_name")).distinct()
    return valid(spark, d).where("section_name IS NOT NULL").select("volume", "section_name").distinct().join(used, "section_name", "left_anti").select("volume", "section_name")


@query("xa32_capture", f"WITH {VA} SELECT printf('%02d-%04d', volume, page_start) AS k, count(*) AS n, min(octet_length(encode(body))) AS least FROM va GROUP BY 1")
def xa32(spark, d):
    return valid(spark, d).groupBy(F.format_string("%02d-%04d", "volume", "page_start").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min(F.octet_length("body")).cast("bigint").alias("least"))


@query("xa33_metric_deltas", "WITH a AS (SELECT xref_type AS metric, count(*) AS v FROM xrefs WHERE loaded_at < TIMESTAMP '2024-01-01' GROUP BY 1), b AS (SELECT xref_type AS metric, count(*) AS v FROM xrefs GROUP BY 1) SELECT metric, coalesce(b.v, 0) - coalesce(a.v, 0) AS change FROM a FULL JOIN b USING (metric)")
def xa33(spark, d):
    x = table(spark, d, "xrefs")
    a = x.where("loaded_at < TIMESTAMP_NTZ '2024-01-01 00:00:00'").groupBy(F.col("xref_type").alias("metric")).agg(F.count(F.lit(1)).alias("a"))
    b = x.groupBy(F.col("xref_type").alias("metric")).agg(F.count(F.lit(1)).alias("b"))
    return a.join(b, "metric", "full_outer").select("metric", (F.coalesce("b", F.lit(0)) - F.coalesce("a", F.lit(0))).alias("change"))


@query("xa34_expressions", "SELECT substr(sha256(e), 1, 16) AS k, min(e) AS expression, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '\\d+ m\\. from [A-Z][a-z]+')) AS e FROM documents) GROUP BY 1")
def xa34(spark, d):
    e = table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"\d+ m\. from [A-Z][a-z]+"), F.lit(0))).alias("e"))
    return e.groupBy(X.digest("e").alias("k")).agg(F.min("e").alias("expression"), F.count(F.lit(1)).alias("n"))


@query("xa35_unique_context", r"""WITH p AS (SELECT DISTINCT id, raw_text AS t FROM source_pages), w AS (SELECT DISTINCT id, t, unnest(regexp_extract_all(t, '[a-z]*[0-9@ſ][a-z]+')) AS w FROM p), c AS (SELECT id, t, w, pad, substr(t, greatest(0, strpos(t, w) - 1 - pad) + 1, strpos(t, w) - 1 + length(w) + pad - greatest(0, strpos(t, w) - 1 - pad)) AS part FROM (SELECT *, unnest(range(0, length(t) + 4, 4)) AS pad FROM w))
SELECT id, w, min_by(part, pad) AS context FROM c WHERE strpos(substr(t, strpos(t, part) + 1), part) = 0 GROUP BY id, w""")
def xa35(spark, d):
    """For each rare word of a page the least context around it that the page has only once."""
    def grow(text: str, at: int, size: int) -> str:
        for pad in range(0, len(text) + 4, 4):
            part = text[max(0, at - pad) : at + size + pad]
            if text.find(part, text.find(part) + 1) < 0:
                break
        return part

    @F.pandas_udf("string")
    def context(texts: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series([grow(t, t.find(w), len(w)) for t, w in zip(texts, words)], dtype=object)

    words = once(spark, d, "source_pages", "id", "raw_text").select("id", "raw_text", F.explode(F.regexp_extract_all("raw_text", F.lit("[a-z]*[0-9@ſ][a-z]+"), F.lit(0))).alias("w")).distinct()
    return words.select("id", "w", context("raw_text", "w").alias("context"))


@query("xa36_leak_pages", "WITH d AS (SELECT DISTINCT doc_id AS id, unnest(regexp_extract_all(text, 'died in \\d{4}')) AS phrase FROM documents), p AS (SELECT DISTINCT id, unnest(regexp_extract_all(raw_text, 'died in \\d{4}')) AS phrase FROM source_pages) SELECT phrase, 'document' AS side, id FROM d WHERE phrase IN (SELECT phrase FROM p) UNION ALL SELECT phrase, 'page', id FROM p WHERE phrase IN (SELECT phrase FROM d)")
def xa36(spark, d):
    """Phrases that documents and pages share, each with its documents and its pages: classes, not all pairs."""
    def said(df, key, text, side):
        return df.select(F.col(key).alias("id"), F.lit(side).alias("side"), F.explode(F.regexp_extract_all(text, F.lit(r"died in \d{4}"), F.lit(0))).alias("phrase")).distinct()

    both = said(table(spark, d, "documents"), "doc_id", "text", "document").unionByName(said(table(spark, d, "source_pages"), "id", "raw_text", "page"))
    shared = both.groupBy("phrase").agg(F.countDistinct("side").alias("n")).where("n = 2").select("phrase")
    return both.join(shared, "phrase", "left_semi").select("phrase", "side", "id")


@query("xa37_asset_references", "SELECT name, count(DISTINCT id) AS n FROM (SELECT id, unnest(regexp_extract_all(wikitext, '\\{\\{(?:rh|[A-Z]+ Page Heading)\\|([^|{}]+)\\|', 1)) AS name FROM source_pages) WHERE name NOT IN (SELECT heading FROM headings) GROUP BY name")
def xa37(spark, d):
    used = table(spark, d, "source_pages").select("id", F.explode(F.regexp_extract_all("wikitext", F.lit(r"\{\{(?:rh|[A-Z]+ Page Heading)\|([^|{}]+)\|"), F.lit(1))).alias("name")).distinct()
    present = table(spark, d, "headings").select(F.col("heading").alias("name"))
    return used.join(present, "name", "left_anti").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("xa38_homonym_qualifiers", "SELECT regexp_extract(heading, '\\(([^()]*)\\)\\s*$', 1) AS q, count(*) AS n FROM headings WHERE regexp_matches(heading, '\\([^()]*\\)\\s*$') GROUP BY 1")
def xa38(spark, d):
    return table(spark, d, "headings").where(F.col("heading").rlike(r"\([^()]*\)\s*$")).groupBy(F.regexp_extract("heading", r"\(([^()]*)\)\s*$", 1).alias("q")).agg(F.count(F.lit(1)).alias("n"))


@query("xa39_find_article", f"WITH {VA} SELECT id, title FROM va WHERE title ILIKE 'saint %' AND page_start BETWEEN 1 AND 40")
def xa39(spark, d):
    return valid(spark, d).where(F.col("title").ilike("saint %") & F.col("page_start").between(1, 40)).select("id", "title")


@query("xa40_requests", "SELECT DISTINCT k FROM (SELECT substr(sha256(lower(surface_text)), 1, 16) AS k FROM xrefs WHERE surface_text IS NOT NULL) WHERE k NOT IN (SELECT substr(sha256(lower(normalized_target)), 1, 16) FROM xrefs WHERE normalized_target IS NOT NULL)")
def xa40(spark, d):
    x = table(spark, d, "xrefs")
    asked = x.where("surface_text IS NOT NULL").select(X.digest(F.lower("surface_text")).alias("k")).distinct()
    return asked.join(x.where("normalized_target IS NOT NULL").select(X.digest(F.lower("normalized_target")).alias("k")), "k", "left_anti")


@query("slice_citations", f"WITH {REFS}, {_T}, m AS (SELECT ref, title FROM refs JOIN titles ON ref = title) SELECT m.title, count(DISTINCT x.id) AS n FROM m JOIN xrefs x ON trim(regexp_replace(upper(x.normalized_target), '\\s+', ' ', 'g')) = m.ref GROUP BY m.title ORDER BY n DESC, m.title LIMIT 50")
def slice_citations(spark, d):
    """The most cited headings: references to keys, keys to titles, titles to counts, the top ones."""
    x = table(spark, d, "xrefs").where("normalized_target IS NOT NULL").select("id", X.collapse_spaces(F.upper("normalized_target")).alias("title")).distinct()
    cited = x.join(titles(spark, d), "title").groupBy("title").agg(F.count(F.lit(1)).alias("n"))
    return cited.orderBy(F.desc("n"), "title").limit(50)


