"""What completes the inventory: parsers of names and templates, kernels over pages, streams."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F

from lexiloom.functions import markup
from lexiloom.functions import text as X
from lexiloom.functions.types import BOOLEAN, STRING, rows
from lexiloom.kernel import markers, styles, wikitext
from lexiloom.operators import sequence
from lexiloom.plans.aggregates import SQL as AGGREGATE_SQL
from lexiloom.plans.common import HEAD, VA, VC, Registry, head_key, once, valid
from lexiloom.plans.joins import _CREDITS, credits
from lexiloom.streaming import events as S
from lexiloom.tables import table

query = Registry()
QUERIES, SQL = query.queries, query.sql


# --- names -------------------------------------------------------------------------------------


@query("st15_match_section", "WITH s AS (SELECT DISTINCT section_name AS s FROM articles WHERE section_name IS NOT NULL), n AS (SELECT DISTINCT target_section AS n FROM xrefs WHERE target_section IS NOT NULL), m AS (SELECT n, s, CASE WHEN lower(n) = lower(s) THEN 1 WHEN ends_with(lower(s), lower(n)) THEN 2 WHEN contains(lower(s), lower(n)) THEN 3 END AS tier FROM n JOIN s ON contains(lower(s), lower(n)) OR lower(s) = lower(n)) SELECT n, min(s) AS s FROM (SELECT *, dense_rank() OVER (PARTITION BY n ORDER BY tier) AS r FROM m) WHERE r = 1 GROUP BY n HAVING count(*) = 1")
def st15(spark, d):
    """Sections by exact name, then as an ending, then inside, if only one fits.

    A name is inside another only where its first three letters (or all, if it is shorter) are, so names
    are cut into their runs of up to three letters and this is an equi-join.
    """
    s = table(spark, d, "articles").where("section_name IS NOT NULL").select(F.col("section_name").alias("s")).distinct()
    n = table(spark, d, "xrefs").where("target_section IS NOT NULL").select(F.col("target_section").alias("n")).distinct()
    low = F.lower("s")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.length("s")), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(3), F.length("s") - i + 1)), lambda k: F.substring(low, i, k))))
    parts = s.where("s <> ''").select("s", F.explode(F.array_distinct(runs)).alias("run"))
    k = F.lower("n")
    tier = F.when(k == low, 1).when(low.endswith(k), 2).when(low.contains(k), 3)
    met = n.where("n <> ''").withColumn("run", F.substring(k, 1, 3)).join(parts, "run").select("n", "s", tier.alias("tier")).where("tier IS NOT NULL")
    best = met.groupBy("n").agg(F.min("tier").alias("tier"))
    return met.join(best, ["n", "tier"]).groupBy("n").agg(F.min("s").alias("s"), F.count(F.lit(1)).alias("c")).where("c = 1").select("n", "s")


PARTICLES = ("van", "von", "de", "du", "d")


@query("st26_person_parts", f"WITH {VC}, w AS (SELECT id, list_filter(regexp_split_to_array(lower(strip_accents(full_name)), '[^a-z]+'), lambda x: x <> '' AND NOT list_contains(['van', 'von', 'de', 'du', 'd'], x)) AS w FROM vc) SELECT id, w[-1] AS surname, array_to_string(list_slice(w, 1, len(w) - 1), ' ') AS givens FROM w")
def st26(spark, d):
    w = F.filter(F.split(F.lower(X.fold_accents("full_name")), "[^a-z]+"), lambda x: (x != "") & ~x.isin(*PARTICLES))
    people = valid(spark, d, "contributors").select("id", w.alias("w"))
    return people.select("id", F.try_element_at("w", F.lit(-1)).alias("surname"), F.array_join(F.slice("w", 1, F.greatest(F.lit(0), F.size("w") - 1)), " ").alias("givens"))


_CANON = r"regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(initials, '<[^>]*>', '', 'g'), '^[✠✝†*\s]+', ''), '\*\s*\.|\.\s*\*', '.*', 'g'), '\*+', '*', 'g'), '\.+', '.', 'g'), '\.([A-Za-z])', '. \1', 'g'), '\s+', ' ', 'g')), '(\p{L})$', '\1.')"


@query("st29_initials_canon", f"SELECT DISTINCT initials AS given, array_to_string(list_transform(string_split({_CANON}, ' '), lambda w: CASE WHEN regexp_matches(w, '^\\p{{Lu}}{{2,}}\\.$') THEN left(w, 1) || lower(substr(w, 2)) ELSE w END), ' ') AS made FROM contributor_initials WHERE initials IS NOT NULL")
def st29(spark, d):
    return table(spark, d, "contributor_initials").where("initials IS NOT NULL").select(F.col("initials").alias("given"), X.canonical_initials("initials").alias("made")).distinct()


@query("st30_footer_lists", "SELECT DISTINCT id, regexp_replace(trim(unnest(string_split(replace(credentials, ',', ';'), ';'))), '\\.$', '') AS letters FROM contributors")
def st30(spark, d):
    return table(spark, d, "contributors").select("id", F.explode(F.split(F.translate("credentials", ",", ";"), ";")).alias("c")).select("id", F.regexp_replace(F.trim("c"), r"\.$", "").alias("letters")).distinct()


@query("st31_name_split", "SELECT DISTINCT id, CASE WHEN regexp_matches(display, ',') THEN array_to_string(list_transform(string_split(lower(trim(regexp_extract(display, ',(.*)$', 1))), ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ') END AS forenames FROM vol29_entries")
def st31(spark, d):
    given = F.lower(F.trim(F.regexp_extract("display", ",(.*)$", 1)))
    cased = F.array_join(F.transform(F.split(given, " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1_000_000))), " ")
    return table(spark, d, "vol29_entries").select("id", F.when(F.col("display").contains(","), cased).alias("forenames")).distinct()


def given_compatible(a, b):
    """Whether the first list of forenames fits into the second in order, initials counting."""
    step = F.aggregate(a, F.lit(1), lambda at, g: F.when(at > 0, _next(at, g, b)).otherwise(0))
    return step > 0


def _next(at, g, b):
    places = F.filter(F.transform(b, lambda x, i: F.when((i + 1 >= at) & ((x == g) | ((F.length(g) == 1) & x.startswith(g))), i + 2)), lambda x: x.isNotNull())
    return F.coalesce(F.array_min(places), F.lit(0))


@query("st32_given_compatible", rf"""WITH {VC}, a AS (SELECT DISTINCT id AS entry_id, list_filter(regexp_split_to_array(lower(strip_accents(full_name)), '[^a-z]+'), lambda x: x <> '') AS w FROM vol29_entries WHERE full_name IS NOT NULL), b AS (SELECT id, list_filter(regexp_split_to_array(lower(strip_accents(full_name)), '[^a-z]+'), lambda x: x <> '') AS w FROM vc)
SELECT entry_id, id FROM a JOIN b ON a.w[-1] = b.w[-1] WHERE regexp_matches(array_to_string(b.w[:-2], ' ') || ' ', '^(?:[a-z]+ )*' || array_to_string(list_transform(a.w[:-2], lambda g: CASE WHEN length(g) = 1 THEN g || '[a-z]* ' ELSE g || ' ' END), '(?:[a-z]+ )*')) OR len(a.w) = 1""")
def st32(spark, d):
    """Contributors and entries of one surname whose forenames go together."""
    def parts(df, name):
        w = F.filter(F.split(F.lower(X.fold_accents(name)), "[^a-z]+"), lambda x: x != "")
        return df.withColumn("sur", F.try_element_at(w, F.lit(-1))).withColumn("g", F.slice(w, 1, F.greatest(F.lit(0), F.size(w) - 1)))

    a = parts(table(spark, d, "vol29_entries").where("full_name IS NOT NULL"), "full_name").select(F.col("id").alias("entry_id"), "sur", F.col("g").alias("ga")).distinct()
    b = parts(valid(spark, d, "contributors"), "full_name").select("id", "sur", F.col("g").alias("gb"))
    return a.join(b, "sur").where(given_compatible(F.col("ga"), F.col("gb"))).select("entry_id", "id")


_FORENAMES = f"{VC}, p AS (SELECT id, lower(string_split(full_name, ' ')[1]) AS f, lower(string_split(full_name, ' ')[-1]) AS s FROM vc WHERE full_name IS NOT NULL), k AS (SELECT s, f, min(id) AS first_id FROM p GROUP BY ALL)"


def _forenames(spark, d):
    w = F.split("full_name", " ")
    p = valid(spark, d, "contributors").where("full_name IS NOT NULL").select("id", F.lower(F.element_at(w, 1)).alias("f"), F.lower(F.element_at(w, -1)).alias("s"))
    return p, p.groupBy("s", "f").agg(F.min("id").alias("class_id"))


@query("st33_first_name_score", f"WITH {_FORENAMES} SELECT least(a.first_id, b.first_id) AS id_a, greatest(a.first_id, b.first_id) AS id_b, CASE WHEN substr(a.f, 1, 1) = substr(b.f, 1, 1) THEN 1 ELSE 0 END AS score FROM k a JOIN k b USING (s) WHERE a.f < b.f")
def st33(spark, d):
    """The scores of every two different forenames of a surname, each by its first record; equal ones (score 2) are one class of ``st33_classes``."""
    _, classes = _forenames(spark, d)
    a, b = (classes.select("s", F.col("f").alias(f"f{z}"), F.col("class_id").alias(f"id_{z}")) for z in "ab")
    score = F.when(F.substring("fa", 1, 1) == F.substring("fb", 1, 1), 1).otherwise(0)
    return a.join(b, "s").where("fa < fb").select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), score.alias("score"))


@query("st33_classes", f"WITH {_FORENAMES} SELECT p.id, k.first_id AS class_id FROM p JOIN k USING (s, f)")
def st33_classes(spark, d):
    p, classes = _forenames(spark, d)
    return p.join(classes, ["s", "f"]).select("id", "class_id")


@query("st50_index_title", "SELECT DISTINCT a AS given, trim(regexp_replace(upper(regexp_replace(a, ',.*$', '')), '[^A-Z0-9]+', ' ', 'g')) AS made FROM (SELECT unnest(articles) AS a FROM vol29_entries)")
def st50(spark, d):
    a = table(spark, d, "vol29_entries").select(F.explode("articles").alias("given")).distinct()
    return a.select("given", F.trim(F.regexp_replace(F.upper(F.regexp_replace("given", ",.*$", "")), "[^A-Z0-9]+", " ")).alias("made"))


# --- source text -------------------------------------------------------------------------------


@query("st35_dehyphenate", r"WITH v AS (" + AGGREGATE_SQL["ag1_hyphen_map"] + r"), c AS (SELECT DISTINCT id, lower(replace(unnest(regexp_extract_all(raw_text, '[A-Za-z]+-\n[A-Za-z]+')), chr(10), '')) AS pair FROM source_pages) SELECT id, c.pair, CASE WHEN coalesce(verdict, 'drop') = 'drop' THEN replace(c.pair, '-', '') ELSE c.pair END AS made FROM c LEFT JOIN v ON v.pair = c.pair")
def st35(spark, d):
    """Pairs that a line end divides, joined or kept as the rest of the corpus writes them."""
    from lexiloom.plans.aggregates import ag1

    cut = table(spark, d, "source_pages").select("id", F.explode(F.regexp_extract_all("raw_text", F.lit(r"([A-Za-z]+-)\n([A-Za-z]+)"), F.lit(0))).alias("c")).distinct()
    pairs = cut.select("id", F.lower(F.translate("c", "\n", "")).alias("pair"))
    return pairs.join(ag1(spark, d).select("pair", "verdict"), "pair", "left").select("id", "pair", F.when(F.coalesce("verdict", F.lit("drop")) == "drop", F.replace("pair", F.lit("-"), F.lit(""))).otherwise(F.col("pair")).alias("made")).distinct()


@query("st37_entities")
def st37(spark, d):
    t = table(spark, d, "source_pages").where("wikitext IS NOT NULL").select("id", "wikitext").distinct()
    return t.select("id", markup.decode_entities("wikitext").alias("decoded"))


#: Templates that are no text; any name that ends in *page heading* is one too.
CHROME = ("rh", "c", "ambox", "hidden text", "pagenum")


@F.pandas_udf(STRING)
def _unfurnished(s: pd.Series) -> pd.Series:
    return s.map(lambda t: wikitext.without_templates(t, CHROME, "page heading"), na_action="ignore")


@query("st39_strip_furniture", "SELECT DISTINCT id, regexp_replace(wikitext, '\\{\\{(rh|c|[A-Z]+ Page Heading)\\|[^{}]*\\}\\}', '', 'g') AS made FROM source_pages WHERE wikitext IS NOT NULL")
def st39(spark, d):
    """Whole templates go, whatever they hold; one that never closes stays."""
    return table(spark, d, "source_pages").where("wikitext IS NOT NULL").select("id", _unfurnished("wikitext").alias("made")).distinct()


@F.pandas_udf(STRING)
def _quotes(s: pd.Series) -> pd.Series:
    return s.map(lambda t: "\n".join(wikitext.quotes(line) for line in t.split("\n")), na_action="ignore")


@query("st40_quote_runs")
def st40(spark, d):
    marked = F.regexp_replace("wikitext", r"\b([A-Z][a-z]+vola)\b", "''$1''")
    return once(spark, d, "source_pages", "id", "wikitext").where("wikitext IS NOT NULL").select("id", _quotes(marked).alias("made"))


@F.pandas_udf(rows("start:int, end:int"))
def _constructs(s: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else [{"start": a, "end": b} for a, b in wikitext.constructs(t)] for t in s], dtype=object)


@query("tx5_construct_ends", "SELECT DISTINCT id, len(regexp_extract_all(wikitext, '<noinclude>\\{\\{[^{}]*\\}\\}</noinclude>|\\{\\{[^{}]*\\}\\}')) AS n FROM source_pages WHERE wikitext IS NOT NULL")
def tx5(spark, d):
    return once(spark, d, "source_pages", "id", "wikitext").where("wikitext IS NOT NULL").select("id", F.size(_constructs("wikitext")).cast("bigint").alias("n"))


@query("tx6_walk")
def tx6(spark, d):
    return once(spark, d, "source_pages", "id", "wikitext").where("wikitext IS NOT NULL").select("id", F.explode(_constructs("wikitext")).alias("c"), "wikitext").select("id", "c.start", "c.end", F.expr("substring(wikitext, c.start + 1, c.end - c.start)").alias("raw"))


@F.pandas_udf(STRING)
def _peeled(s: pd.Series) -> pd.Series:
    return s.map(lambda t: "|".join(sorted({f"{e.label}:{len(e.args)}" for e in wikitext.parse(t).children if isinstance(e, wikitext.Element)})), na_action="ignore")


@query("tx7_shapes")
def tx7(spark, d):
    return once(spark, d, "source_pages", "id", "wikitext").where("wikitext IS NOT NULL").select("id", _peeled("wikitext").alias("shapes"))


@F.pandas_udf(STRING)
def _styled(s: pd.Series) -> pd.Series:
    return s.map(styles.rules, na_action="ignore")


@query("tx13_style_codes", """WITH c AS (SELECT DISTINCT page_number AS n FROM source_pages) SELECT n, CASE n % 3 WHEN 0 THEN 'text-align:right' WHEN 1 THEN 'text-align:center' ELSE 'vertical-align:text-top' END || ';border-' || CASE n % 4 WHEN 0 THEN 'left' WHEN 1 THEN 'right' WHEN 2 THEN 'top' ELSE 'bottom' END || ':' || (n % 2 + 2) || 'px solid;padding-left:' || CASE WHEN n % 8 = 0 THEN '0' ELSE (n % 8) || 'em' END || ';font-size:' || (80 + n % 40) || '%' AS css FROM c""")
def tx13(spark, d):
    """Codes of cells as rules; one code of each is unknown and shows nothing."""
    n = F.col("n")
    code = F.concat_ws(
        "|", F.element_at(F.array(F.lit("ar"), F.lit("Center"), F.lit("vtt")), n % 3 + 1), F.concat(F.lit("b"), F.element_at(F.array(*map(F.lit, "lrtb")), n % 4 + 1), (n % 2 + 2).cast("string")), F.lit("xx"),
        F.concat(F.lit("pl"), (n % 8).cast("string")), F.concat(F.lit("fs"), F.lpad((80 + n % 40).cast("string"), 3, "0")),
    )
    return table(spark, d, "source_pages").select(F.col("page_number").alias("n")).distinct().select("n", _styled(code).alias("css"))


@F.pandas_udf(STRING)
def _relinked(s: pd.Series) -> pd.Series:
    return s.map(lambda t: re.sub(r"«LN:([^«»|]*)\|([^«»]*)»", lambda m: f"«LN:{wikitext.slug(m.group(1))}|{m.group(1)}|{m.group(2)}»", t), na_action="ignore")


@query("tx18_rewrite_links")
def tx18(spark, d):
    return valid(spark, d).select("id", _relinked("body").alias("body"))


@query("tx19_link_targets", "SELECT DISTINCT surface_text AS s, trim(regexp_extract(surface_text, '^«[A-Z]+:([^|»]*)', 1)) AS target, trim(regexp_extract(surface_text, '\\|([^|»]*)»$', 1)) AS display FROM xrefs WHERE starts_with(surface_text, '«')")
def tx19(spark, d):
    s = F.col("surface_text")
    return table(spark, d, "xrefs").where(s.startswith("«")).select(s.alias("s"), F.trim(F.regexp_extract(s, "^«[A-Z]+:([^|»]*)", 1)).alias("target"), F.trim(F.regexp_extract(s, r"\|([^|»]*)»$", 1)).alias("display")).distinct()


@query("tx20_producers")
def tx20(spark, d):
    """What each kind of element of the pages is made into, with one example."""
    @F.pandas_udf(rows("label:string, made:string"))
    def made(s: pd.Series) -> pd.Series:
        out = []
        for t in s:
            p = wikitext.Producer()
            out.append([{"label": e.label, "made": p.element(e)} for e in wikitext.parse(t).children if isinstance(e, wikitext.Element)])
        return pd.Series(out, dtype=object)

    e = once(spark, d, "source_pages", "id", "wikitext").where("wikitext IS NOT NULL").select(F.explode(made("wikitext")).alias("e"))
    return e.groupBy(F.col("e.label").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.min("e.made").alias("example"))


@query("tx22_template_parameters", "SELECT DISTINCT id, string_split(t, '|')[1] AS name, string_split(t, '|')[2] AS first, string_split(t, '|')[3] AS second FROM (SELECT id, unnest(regexp_extract_all(wikitext, '\\{\\{([^{}]*)\\}\\}', 1)) AS t FROM source_pages)")
def tx22(spark, d):
    t = table(spark, d, "source_pages").select("id", F.explode(F.regexp_extract_all("wikitext", F.lit(r"\{\{([^{}]*)\}\}"), F.lit(1))).alias("t")).select("id", F.split("t", r"\|").alias("p"))
    return t.select("id", *[F.try_element_at("p", F.lit(i)).alias(n) for i, n in ((1, "name"), (2, "first"), (3, "second"))]).distinct()


@query("tx23_inline_html")
def tx23(spark, d):
    return once(spark, d, "xrefs", "id", "surface_text").where("surface_text IS NOT NULL").select("id", markup.html("surface_text").alias("html"))


@query("tx24_page_signatures", f"WITH {VA}, b AS (SELECT id AS article_id, regexp_replace(lower(body), '[^a-z]', '', 'g') AS letters FROM va) SELECT DISTINCT s.id, substr(b.letters, s.body_offset + 1, 12) AS signature FROM article_segments s JOIN b USING (article_id)")
def tx24(spark, d):
    letters = valid(spark, d).select(F.col("id").alias("article_id"), F.regexp_replace(F.lower("body"), "[^a-z]", "").alias("letters"))
    return table(spark, d, "article_segments").join(letters, "article_id").select("id", F.substring("letters", F.col("body_offset") + 1, F.lit(12)).alias("signature")).distinct()


#: Headings that titles are aligned with in one task.
MOST_HEADINGS = 100_000


@query("wn16_aligned_bands")
def wn16(spark, d):
    """Titles of a volume against the order of the headings: the rows that an alignment keeps."""
    known = [r["heading"] for r in table(spark, d, "headings").select("heading").where("heading IS NOT NULL").orderBy("heading").limit(MOST_HEADINGS + 1).collect()]
    if len(known) > MOST_HEADINGS:
        raise ValueError("the list of headings is too long to be aligned with")

    def align(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["page_start", "id"], kind="stable")
        names = sorted(frame["title"].tolist())
        inside = set(names)
        kept = {i + k for i, _, n in SequenceMatcher(None, names, [h for h in known if h in inside], autojunk=False).get_matching_blocks() for k in range(n)}
        marked = {names[i] for i in kept}
        return frame.assign(aligned=[t in marked for t in frame["title"]])[["id", "volume", "title", "aligned"]]

    rows_ = valid(spark, d).where("title IS NOT NULL").select("id", "volume", "page_start", "title")
    return rows_.groupBy("volume").applyInPandas(align, "id bigint, volume int, title string, aligned boolean")


# --- supporting operators ----------------------------------------------------------------------


@query("sc6_known_titles", "SELECT DISTINCT normalized_target AS t FROM xrefs WHERE upper(trim(normalized_target)) IN (SELECT upper(title) FROM articles)")
def sc6(spark, d):
    known = table(spark, d, "articles").select(F.upper("title").alias("k")).where("k IS NOT NULL").distinct()
    x = table(spark, d, "xrefs").select(F.col("normalized_target").alias("t"), F.upper(F.trim("normalized_target")).alias("k"))
    return x.join(known, "k", "left_semi").select("t").distinct()


@query("sc11_confident_readings", "SELECT DISTINCT id, TRY_CAST(regexp_extract(raw_text, '(?m)^\\s*\\[?(\\d{1,3})\\]?\\s{2,}[A-Z]', 1) AS INT) AS page FROM source_pages WHERE regexp_matches(raw_text, '(?m)^\\s*\\[?(\\d{1,3})\\]?\\s{2,}[A-Z]')")
def sc11(spark, d):
    p = r"(?m)^\s*\[?(\d{1,3})\]?\s{2,}[A-Z]"
    return table(spark, d, "source_pages").where(F.col("raw_text").rlike(p)).select("id", F.regexp_extract("raw_text", p, 1).cast("int").alias("page")).distinct()


@query("xa5_plain_resolve", f"WITH {VA} SELECT DISTINCT x.id, t.id AS article_id FROM xrefs x JOIN (SELECT upper(title) AS k, min(id) AS id FROM va GROUP BY 1 HAVING count(*) = 1) t ON t.k = upper(trim(x.normalized_target))")
def xa5(spark, d):
    one = valid(spark, d).groupBy(F.upper("title").alias("k")).agg(F.min("id").alias("article_id"), F.count(F.lit(1)).alias("n")).where("n = 1")
    return table(spark, d, "xrefs").select("id", F.upper(F.trim("normalized_target")).alias("k")).join(one, "k").select("id", "article_id").distinct()


@query("xa8_bind_credits", f"WITH {VA}, c AS ({_CREDITS}) SELECT c.credit_id, min(va.id) AS article_id FROM c JOIN va ON {HEAD.format('va.title')} = {HEAD.format('c.subject')} GROUP BY 1")
def xa8(spark, d):
    """The first article that goes by the name of a credit."""
    rows = valid(spark, d).groupBy(head_key("title").alias("k")).agg(F.min("id").alias("article_id"))
    return credits(spark, d).withColumn("k", head_key("subject")).join(rows, "k").select("credit_id", "article_id")


@query("xa13_parts", "WITH p AS (SELECT DISTINCT id, string_split(raw_text, chr(10) || chr(10)) AS p FROM source_pages WHERE raw_text IS NOT NULL) SELECT id, unnest(range(1, len(p) + 1)) AS part, length(unnest(p)) AS chars FROM p")
def xa13(spark, d):
    return once(spark, d, "source_pages", "id", "raw_text").where("raw_text IS NOT NULL").select("id", F.posexplode(F.split("raw_text", "\n\n")).alias("pos", "t")).select("id", (F.col("pos") + 1).cast("bigint").alias("part"), F.length("t").cast("bigint").alias("chars"))


@query("xa14_band_sequence", f"WITH RECURSIVE {VA}, s AS (SELECT volume, id, substr(title, 1, 1) AS letter, row_number() OVER (PARTITION BY volume ORDER BY page_start, id) AS i FROM va WHERE title IS NOT NULL), w AS (SELECT volume, id, i, CASE WHEN letter = 'A' THEN 0 ELSE -1 END AS category FROM s WHERE i = 1 UNION ALL SELECT s.volume, s.id, s.i, CASE WHEN s.letter = chr(66 + w.category) THEN w.category + 1 ELSE w.category END FROM w JOIN s ON s.volume = w.volume AND s.i = w.i + 1) SELECT id, category FROM w")
def xa14(spark, d):
    """The letter that each volume's titles have reached when read in page order."""
    rows_ = valid(spark, d).where("title IS NOT NULL").select("volume", "page_start", "id", F.substring("title", 1, 1).alias("letter"))
    at = F.col("page_start").cast("bigint") * 100_000_000_000 + F.col("id")
    return sequence.known_order(rows_.select("volume", at.alias("at"), "id", "letter"), "volume", "at", "letter", [[c] for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"], "volume int, at bigint, id bigint, letter string, category int").select("id", "category")


@query("xa15_index_levels", "SELECT heading_id, CASE WHEN contains(heading, ',') THEN 2 WHEN contains(heading, '(') THEN 1 ELSE 0 END AS level, split_part(heading, ',', 1) AS name FROM headings")
def xa15(spark, d):
    h = F.col("heading")
    return table(spark, d, "headings").select("heading_id", F.when(h.contains(","), 2).when(h.contains("("), 1).otherwise(0).alias("level"), F.substring_index("heading", ",", 1).alias("name"))


@query("xa16_general_sections", "SELECT category, count(*) FILTER (heading ILIKE '%history%' OR heading ILIKE '%general%' OR heading ILIKE '%chronology%') AS general, count(*) AS n FROM headings GROUP BY 1")
def xa16(spark, d):
    g = F.col("heading").ilike("%history%") | F.col("heading").ilike("%general%") | F.col("heading").ilike("%chronology%")
    return table(spark, d, "headings").groupBy("category").agg(F.count_if(g).alias("general"), F.count(F.lit(1)).alias("n"))


@query("xa17_node_norms", "SELECT DISTINCT regexp_replace(upper(strip_accents(heading)), '[^A-Z0-9]+', '', 'g') AS norm FROM headings")
def xa17(spark, d):
    return table(spark, d, "headings").select(X.article_norm("heading").alias("norm")).distinct()


@query("xa24_markdown_lists")
def xa24(spark, d):
    """Notes and emphasis of the articles as Markdown, by document."""
    made = valid(spark, d).select("id", markup.markdown("body").alias("m"))
    return made.select("id", F.size(F.regexp_extract_all("m", F.lit(r"(?m)^\[\^\d+\]:"), F.lit(0))).alias("notes"), F.size(F.regexp_extract_all("m", F.lit(r"\*\*[^*]+\*\*"), F.lit(0))).alias("bold"))


@F.pandas_udf(BOOLEAN)
def _closed(s: pd.Series) -> pd.Series:
    return s.map(lambda t: not markers.crossing(t) and not markers.dangling(t), na_action="ignore")


@query("xa26_contained", f"WITH {VA} SELECT id, TRUE AS contained FROM va")
def xa26(spark, d):
    return valid(spark, d).select("id", _closed("body").alias("contained"))


@query("xa28_plate_signals", f"WITH {VA} SELECT id, title AS signal FROM va WHERE article_type = 'plate'")
def xa28(spark, d):
    return valid(spark, d).where("article_type = 'plate'").select("id", F.element_at(F.array_distinct(F.array("title", F.substring_index("title", ",", 1))), 1).alias("signal"))


@query("ud2_value_of", "SELECT regexp_replace(upper(strip_accents(heading)), '[^A-Z0-9]+', '', 'g') AS key, min_by(category, (category, heading_id)) AS category, min_by(heading_id, (category, heading_id)) AS heading_id, count(*) AS n FROM headings GROUP BY 1")
def ud2(spark, d):
    """An index whose value is any expression of the row."""
    def index(df, key, value):
        return df.groupBy(key.alias("key")).agg(F.min(value).alias("value"), F.count(F.lit(1)).alias("n"))

    return index(table(spark, d, "headings"), X.article_norm("heading"), F.struct("category", "heading_id")).select("key", "value.*", "n")


# --- streams -----------------------------------------------------------------------------------


@query("stream_event_windows", "WITH w AS (SELECT date_trunc('day', ts) AS starts, event_type, count(*) AS n, round(sum(value), 3) AS total FROM events GROUP BY 1, 2) SELECT * FROM w WHERE starts + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)")
def stream_windows(spark, d):
    """Windows of a day that can get no more events: those that end an hour before the last one, or earlier."""
    counted = S.windowed_counts(S.read_table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type", "value")
    return S.drain(counted).select(F.col("starts").cast("timestamp_ntz").alias("starts"), "event_type", "n", F.round("total", 3).alias("total"))


@query("stream_distinct_events", "SELECT event_id, event_type FROM events GROUP BY ALL")
def stream_distinct(spark, d):
    stream = S.read_table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return S.drain(S.distinct_events(stream, "event_id", "ts", "3650 days").select("event_id", "event_type"))


@query("stream_upsert_pages", "SELECT DISTINCT id, volume, page_number FROM source_pages")
def stream_upsert(spark, d):
    target = S.shared_folder(spark, "pages")
    S.ingest(S.read_table(spark, d, "source_pages").select("id", "volume", "page_number"), target, ["id"])
    return spark.read.parquet(target).drop("batch")

