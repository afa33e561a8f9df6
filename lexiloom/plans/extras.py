"""Round trips through files, extension points and the last kernel rows of the inventory."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F

from lexiloom.functions import markup
from lexiloom.functions import text as X
from lexiloom.functions.types import STRING, rows, struct
from lexiloom.kernel import markers, wikitext
from lexiloom.operators import resolve
from lexiloom.plans.common import VA, Registry, once, valid
from lexiloom.sources import readers, sinks
from lexiloom.streaming.events import shared_folder
from lexiloom.tables import table

query = Registry()
QUERIES, SQL = query.queries, query.sql


# --- files -------------------------------------------------------------------------------------


@query("sc1_page_files", "SELECT DISTINCT volume, page_number, raw_text FROM source_pages WHERE raw_text <> ''")
def sc1(spark, d):
    """Pages written as JSON Lines and read again through the checks of the reader."""
    pages = once(spark, d, "source_pages", "volume", "page_number", "raw_text").where("raw_text <> ''")
    folder = shared_folder(spark, "page-files")
    pages.write.json(folder)
    read = spark.read.schema("volume int, page_number int, raw_text string, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(folder)
    checks = [("unreadable", F.col("_corrupt").isNull()), ("missing field", F.col("raw_text").isNotNull() & F.col("volume").isNotNull() & F.col("page_number").isNotNull())]
    good, failures = readers.split_valid(read, F.input_file_name(), checks)
    return readers.settle(good, failures, strict=True)[0].select("volume", "page_number", "raw_text")


@query("sc4_failure_reasons", "SELECT 'blank text' AS reason, count(*) AS n FROM source_pages WHERE trim(coalesce(raw_text, ''), chr(10) || ' ') = '' HAVING count(*) > 0")
def sc4(spark, d):
    pages = table(spark, d, "source_pages")
    _, failures = readers.split_valid(pages, F.col("id"), [("blank text", F.trim(F.coalesce("raw_text", F.lit("")), F.lit("\n ")) != "")])
    return failures.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("sk1_replace_volumes", f"WITH {VA} SELECT id, volume, CASE WHEN volume = 2 THEN 'second' ELSE 'first' END AS build FROM va")
def sk1(spark, d):
    """All volumes written as partitions, then one of them again: the others stay as they were."""
    rows_ = valid(spark, d).select("id", "volume")
    folder = shared_folder(spark, "articles")
    sinks.write_partitions(rows_.withColumn("build", F.lit("first")), folder)
    sinks.write_partitions(rows_.where("volume = 2").withColumn("build", F.lit("second")), folder)
    return spark.read.parquet(folder).select("id", "volume", "build")


@query("sk3_payload_lines", f"WITH {VA} SELECT id, title, volume FROM va")
def sk3(spark, d):
    rows_ = valid(spark, d).select("id", "title", "volume")
    folder = shared_folder(spark, "payloads")
    sinks.write_bundle({"articles": rows_}, folder)
    return spark.read.schema(rows_.schema).json(f"{folder}/articles")


@query("sk8_search_batches", f"WITH {VA} SELECT CAST(count(*) AS BIGINT) AS n_documents FROM va")
def sk8(spark, d):
    """Documents handed out in batches of 500 from the executors; every batch says what it sent when the result is asked for."""
    sent = sinks.sent_batches(valid(spark, d).select("id"), lambda batch: len(batch))
    return sent.agg(F.coalesce(F.sum("answer"), F.lit(0)).alias("n_documents"))


@query("so2_page_order", f"WITH {VA} SELECT id, volume, page_start, title FROM va")
def so2(spark, d):
    return valid(spark, d).select("id", "volume", "page_start", "title").orderBy("volume", "page_start", "title")


_ALIAS_FORM = "trim(regexp_replace(translate(nfc_normalize({0}), '’‘`“”', chr(39) || chr(39) || chr(39) || '\"\"'), '\\s+', ' ', 'g'))"


@query("st28_canonical_names", f"WITH n AS (SELECT DISTINCT {_ALIAS_FORM.format('full_name')} AS variant FROM contributors WHERE full_name IS NOT NULL), a AS (SELECT variant, min(variant) OVER (PARTITION BY lower(strip_accents(variant))) AS canonical FROM n) SELECT DISTINCT e.id, coalesce(a.canonical, {_ALIAS_FORM.format('e.full_name')}) AS name FROM vol29_entries e LEFT JOIN a ON a.variant = {_ALIAS_FORM.format('e.full_name')}")
def st28(spark, d):
    """Names in the form they are stored in, variants as the least spelling that differs from them in accents and case alone."""
    names = table(spark, d, "contributors").where("full_name IS NOT NULL").select(X.alias_form("full_name").alias("variant")).distinct().withColumn("k", F.lower(X.fold_accents("variant")))
    known = names.join(names.groupBy("k").agg(F.min("variant").alias("canonical")), "k").select("variant", "canonical")
    entries = table(spark, d, "vol29_entries").select("id", X.alias_form("full_name").alias("variant"))
    return entries.join(known, "variant", "left").select("id", F.coalesce("canonical", "variant").alias("name")).distinct()


# --- kernel ------------------------------------------------------------------------------------


@F.pandas_udf(STRING)
def _restyled(s: pd.Series) -> pd.Series:
    return s.map(lambda t: wikitext.produce(re.sub(r"\b(the [a-z]+)\b", r"{{sc|\1}}", t, count=1)), na_action="ignore")


@query("tx21_stylers")
def tx21(spark, d):
    """Pages with a styled phrase, as their streams carry it."""
    return once(spark, d, "source_pages", "id", "wikitext").where("wikitext IS NOT NULL").select("id", _restyled("wikitext").alias("stream"))


@F.pandas_udf(rows("row:int, col:int, text:string"))
def _grid(s: pd.Series) -> pd.Series:
    out = []
    for t in s:
        lines = [re.split(r"\s{2,}", x.strip()) for x in t.split("\n") if re.match(r"^\d+\s{2,}\d+\s{2,}\d+$", x)]
        source = "{|\n" + "\n|-\n".join("| " + " || ".join(cells) for cells in lines) + "\n|}" if lines else ""
        stream = wikitext.produce(source) or ""
        grids = [markers.Markdown().grid(n) for n in markers.parse(stream) if isinstance(n, markers.Mark) and n.name == "TABLE"]
        out.append([{"row": i, "col": j, "text": c} for g in grids for i, line in enumerate(g) for j, c in enumerate(line)])
    return pd.Series(out, dtype=object)


@query("xa19_table_assembly", "WITH l AS (SELECT id, unnest(string_split(raw_text, chr(10))) AS line FROM (SELECT DISTINCT id, raw_text FROM source_pages WHERE raw_text IS NOT NULL)) SELECT id, CAST(count(*) AS BIGINT) AS n_rows, CAST(3 * count(*) AS BIGINT) AS n_cells FROM l WHERE regexp_matches(line, '^\\d+\\s{2,}\\d+\\s{2,}\\d+$') GROUP BY id")
def xa19(spark, d):
    """Columns of figures in the pages, rebuilt as tables and read back as full grids."""
    cells = once(spark, d, "source_pages", "id", "raw_text").where("raw_text IS NOT NULL").select("id", F.explode(_grid("raw_text")).alias("c"))
    return cells.groupBy("id").agg(F.countDistinct("c.row").alias("n_rows"), F.count(F.lit(1)).alias("n_cells"))


@query("xa18_composites")
def xa18(spark, d):
    """Elements that hold other elements, with what they hold."""
    e = once(spark, d, "source_pages", "id", "wikitext").where("wikitext IS NOT NULL").select("id", F.explode(markup.elements("wikitext")).alias("e")).select("id", "e.path", "e.label")
    inner = e.select("id", F.regexp_replace("path", "/[^/]+$", "").alias("path"), F.col("label").alias("inside")).where("path <> ''")
    return e.join(inner, ["id", "path"]).groupBy("label", "inside").agg(F.count(F.lit(1)).alias("n"))


@F.pandas_udf(struct("expression:string, label:string"))
def _equation(s: pd.Series) -> pd.DataFrame:
    parts = [re.match(r"^(.*?)\s*(?:\((\d+)\))?\s*$", t or "", re.S).groups() for t in s]
    return pd.DataFrame([(a, b) for a, b in parts], columns=["expression", "label"])


@query("xa20_equation_labels", "SELECT DISTINCT doc_id, regexp_extract(s, '\\((\\d+)\\)$', 1) AS label, trim(regexp_extract(s, '^(.*)\\(\\d+\\)$', 1)) AS expression FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^().\\n]*\\(\\d+\\)')) AS s FROM documents)")
def xa20(spark, d):
    found = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[^().\n]*\(\d+\)"), F.lit(0))).alias("s"))
    return found.select("doc_id", _equation("s").alias("e")).select("doc_id", F.col("e.label").alias("label"), F.trim("e.expression").alias("expression")).distinct()


@F.pandas_udf(rows("label:string, inner:string"))
def _peel(s: pd.Series) -> pd.Series:
    out = []
    for t in s:
        out.append([{"label": e.label, "inner": wikitext.plain(e) if e.children else "|".join(e.args)} for e in wikitext.parse(t).children if isinstance(e, wikitext.Element)])
    return pd.Series(out, dtype=object)


@query("xa21_peeled")
def xa21(spark, d):
    return once(spark, d, "source_pages", "id", "wikitext").where("wikitext IS NOT NULL").select("id", F.posexplode(_peel("wikitext")).alias("pos", "e")).select("id", "pos", "e.label", "e.inner")


@query("xa22_link_slots")
def xa22(spark, d):
    """Link marks of the references by their readers: kind, target and display."""
    x = once(spark, d, "xrefs", "id", "surface_text").where("surface_text IS NOT NULL")
    return x.select("id", F.explode(markup.links("surface_text")).alias("l")).select("id", "l.type", "l.target", "l.display")


@query("xa23_prepared", f"WITH {VA} SELECT id, regexp_replace(regexp_extract(body, '^\\s*(«B»[^«»]*«/B»)', 1), '«/?B»', '', 'g') AS title FROM va WHERE starts_with(body, '«B»') AND NOT regexp_matches(body, '^«B»[^«»]*«/B»[\\s,]*«B»')")
def xa23(spark, d):
    rows_ = valid(spark, d).where(F.col("body").startswith("«B»") & ~F.col("body").rlike(r"^«B»[^«»]*«/B»[\s,]*«B»"))
    return rows_.select("id", markup.carve_title("body").alias("t")).select("id", "t.title")


@query("xa25_tei_parts", f"WITH {VA} SELECT id, len(regexp_extract_all(body, '«FN:')) AS notes, len(regexp_extract_all(body, '«I»')) AS italics FROM va")
def xa25(spark, d):
    made = valid(spark, d).select("id", markup.tei("body", "title", "volume", F.lit("")).alias("t"))
    return made.select("id", F.size(F.regexp_extract_all("t", F.lit("<note "), F.lit(0))).cast("bigint").alias("notes"), F.size(F.regexp_extract_all("t", F.lit('<hi rend="italic">'), F.lit(0))).cast("bigint").alias("italics"))


@F.pandas_udf(STRING)
def _namespaced(html: pd.Series, stem: pd.Series) -> pd.Series:
    return pd.Series([re.sub(r'(id="|href="#)', rf"\1{k}-", h or "") for h, k in zip(html, stem)], dtype=object)


@query("xa27_namespaced_ids")
def xa27(spark, d):
    """The HTML of every article with its ids made unique in a book."""
    return valid(spark, d).select("id", _namespaced(markup.html("body"), F.concat(F.lit("a"), F.col("id").cast("string"))).alias("xhtml"))


# --- extension points --------------------------------------------------------------------------


def rewriter(rewrite):
    """A column function that rewrites every link mark by a callback on its target and display."""

    @F.pandas_udf(STRING)
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: re.sub(r"«(LN|AL):([^«»|]*)\|([^«»]*)»", lambda m: rewrite(m.group(2), m.group(3)), t), na_action="ignore")

    return run


@query("ud1_callbacks", "SELECT DISTINCT id, regexp_replace(surface_text, '«(LN|AL):([^«»|]*)\\|([^«»]*)»', '[\\3 = \\2]', 'g') AS made FROM xrefs WHERE surface_text IS NOT NULL")
def ud1(spark, d):
    show = rewriter(lambda target, display: f"[{display} = {target}]")
    return once(spark, d, "xrefs", "id", "surface_text").where("surface_text IS NOT NULL").select("id", show("surface_text").alias("made"))


@query("ud3_lead_of", f"WITH {VA} SELECT upper(split_part(title, ',', 1)) AS ref, min(id) AS id FROM va WHERE contains(lower(substr(body, 1, 200)), 'the') GROUP BY 1 HAVING count(*) = 1")
def ud3(spark, d):
    """A pick whose evidence is any expression on the candidate's lead."""
    lead_of = F.lower(F.substring("body", 1, 200))
    rows_ = valid(spark, d).select(F.upper(F.substring_index("title", ",", 1)).alias("ref"), "id", lead_of.alias("lead"))
    return resolve.only(rows_, "ref", F.col("lead").contains("the")).select("ref", "id")


@query("ud4_salience", "WITH h AS (SELECT upper(split_part(heading, ',', 1)) AS ref, heading_id, category FROM headings), k AS (SELECT ref, min(heading_id) AS heading_id FROM h WHERE category = 'place' GROUP BY ref HAVING count(*) = 1) SELECT ref, heading_id, 'kind' AS method FROM k UNION ALL SELECT ref, min(heading_id), 'salience' FROM h WHERE ref NOT IN (SELECT ref FROM k) GROUP BY ref")
def ud4(spark, d):
    """A pick with an injected salience, used only where nothing before it decides."""
    h = table(spark, d, "headings").select(F.upper(F.substring_index("heading", ",", 1)).alias("ref"), "heading_id", "category")
    salience = 1.0 / F.col("heading_id")
    return resolve.fish(h, "ref", "heading_id", [("kind", (F.col("category") == "place").cast("double")), ("salience", salience)])


@query("ud5_decorate", f"WITH {VA} SELECT id, upper(title) || '!' AS title FROM va")
def ud5(spark, d):
    """A hook on the finished rows."""
    def decorate(df):
        return df.withColumn("title", F.concat(F.upper("title"), F.lit("!")))

    return valid(spark, d).select("id", "title").transform(decorate)


class Bracketed(wikitext.Producer):
    """A producer with one label made otherwise."""

    def _small_caps(self, node):
        return f"[{self._inner(node)}]"


@F.pandas_udf(STRING)
def _bracketed(s: pd.Series) -> pd.Series:
    return s.map(lambda t: Bracketed().body(f"{{{{sc|{t}}}}}"), na_action="ignore")


@query("ud6_dispatch", "SELECT heading_id, '[' || heading || ']' AS made FROM headings")
def ud6(spark, d):
    return table(spark, d, "headings").select("heading_id", _bracketed("heading").alias("made"))


@query("ud8_injected_titles", "SELECT n_nationkey AS id, r_name AS title FROM nation JOIN region ON r_regionkey = n_regionkey WHERE starts_with(r_name, 'A')")
def ud8(spark, d):
    """A resolver takes any titles: here the regions that begin with A."""
    names = table(spark, d, "region").where(F.col("r_name").startswith("A")).select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("title"))
    return table(spark, d, "nation").join(names, F.col("n_regionkey") == F.col("k")).select(F.col("n_nationkey").alias("id"), "title")
