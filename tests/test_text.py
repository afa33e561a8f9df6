from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom.functions import text as X
from lexiloom.functions import vectors as V
from lexiloom.kernel import markers, wikitext
from lexiloom.operators import ladder


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v")).alias("r")).first()["r"]


def test_text_functions(spark):
    cases = [
        (X.fold_accents, "Zürich, Ångström ø ß", "Zurich, Angstrom ø ß"), (X.slug, " St. Gall's Abbey ", "st-gall-s-abbey"), (X.title_case, "THE HISTORY OF THE ABBEY", "The History of the Abbey"),
        (X.primary_headword, "«B»AARSSENS«/B», or Aarssen, FRANCIS VAN", "AARSSENS"), (X.primary_headword, "ADAM (or Adan) DE LE HALE", "ADAM DE LE HALE"), (X.primary_headword, "ALBERT (FRANCIS", "ALBERT"),
        (X.xref_target, " s:Napoleon  I. ", "NAPOLEON I"), (X.xref_target, "Queen Anne’s Bounty#History", "QUEEN ANNE'S BOUNTY: HISTORY"), (X.xref_target, "Æneas—the “Great”, of Troy...", "AENEAS THE GREAT OF TROY"),
        (X.section_key, "I. — Early History", "iearlyhistory"), (X.strip_honorifics, "Rt. Hon. Sir John Smith", "John Smith"), (X.surname_fold, "MacDonald", "mcdonald"), (X.surname_fold, "M’Lean", "mclean"),
        (X.invert_name, "BRAHE, TYCHO", "TYCHO BRAHE"), (X.invert_name, "Tycho Brahe", "Brahe, Tycho"), (X.initials_key, "(J. A. M*)", "JAM"), (X.qualifier, "ABEL (chemist)", "chemist"),
        (X.plain_text, "«B»X«/B»«P»a «LN:t|shown»«FN:note«/FN».", "X a shown."), (X.escape_html, '<a href="x">&', "&lt;a href=&quot;x&quot;&gt;&amp;"),
    ]
    for f, value, expected in cases:
        assert one(spark, value, f) == expected, f.__name__
    assert all(one(spark, None, f) is None for f, _, _ in cases)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text("aB#:.,’-–Æ “”", max_size=15), min_size=1, max_size=20))
def test_the_reference_key_is_stable(values):
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.getOrCreate()
    df = spark.createDataFrame([(v.replace(":", ""),) for v in values], "v string")
    assert df.select(X.xref_target("v").alias("a"), X.xref_target(X.xref_target("v")).alias("b")).where("a <> b").count() == 0


def test_vectors(spark):
    row = spark.sql("SELECT array(3.0D, 4.0D) a, array(0.0D, 0.0D) z, CAST(NULL AS ARRAY<DOUBLE>) n")
    got = row.select(V.cosine("a", "a").alias("same"), V.cosine("a", "z").alias("zero"), V.cosine("a", "n").alias("none"), V.unit("a").alias("u")).first()
    assert got["same"] == 1 and got["zero"] == got["none"] == -1 and got["u"] == [0.6, 0.8]


def test_ladder_prefers_the_tighter_rung(spark):
    titles = spark.createDataFrame([("ABBEY",), ("DECLARATION OF INDEPENDENCE",), ("FLETCHER, ALICE CUNNINGHAM",), ("RENÉ DESCARTES",), ("UNIFORMS",)], "title string")
    refs = spark.createDataFrame([(r,) for r in ("ABBEY", "UNITED STATES DECLARATION OF INDEPENDENCE", "FLETCHER, ALICE C.", "RENE DESCARTES", "UNIFORMS, NAVAL AND MILITARY", "SOMETHING ELSE")], "ref string")
    got = {r["ref"]: (r["title"], r["rung"]) for r in ladder.ladder(refs, titles).collect()}
    assert got == {
        "ABBEY": ("ABBEY", "exact"), "UNITED STATES DECLARATION OF INDEPENDENCE": ("DECLARATION OF INDEPENDENCE", "superset"), "FLETCHER, ALICE C.": ("FLETCHER, ALICE CUNNINGHAM", "subset"),
        "RENE DESCARTES": ("RENÉ DESCARTES", "fold"), "UNIFORMS, NAVAL AND MILITARY": ("UNIFORMS", "superset"),
    }


def test_cascade_strategies(spark):
    titles = spark.createDataFrame([(t,) for t in ("BERRY", "BRAHE, TYCHO", "BACH, JOHANN SEBASTIAN", "CLIMATE AND CLIMATOLOGY", "EUROPE", "GRAIL", "BERBERS", "JOINTS", "EDWARD VII")], "title string")
    refs = spark.createDataFrame([(r,) for r in ("BERRIES", "TYCHO BRAHE", "BACH, J. S.", "CLIMATE", "EUROPE: HISTORY", "GRAIL, THE HOLY", "BORBERS", "JOINTS (ANATOMY)", "EDWARD VII.", "NOBODY")], "ref string")
    got = {r["ref"]: r["title"] for r in ladder.cascade(refs, titles, aggressive=True).collect()}
    assert got == {
        "BERRIES": "BERRY", "TYCHO BRAHE": "BRAHE, TYCHO", "BACH, J. S.": "BACH, JOHANN SEBASTIAN", "CLIMATE": "CLIMATE AND CLIMATOLOGY", "EUROPE: HISTORY": "EUROPE", "GRAIL, THE HOLY": "GRAIL",
        "BORBERS": "BERBERS", "JOINTS (ANATOMY)": "JOINTS", "EDWARD VII.": "EDWARD VII",
    }
    assert "BORBERS" not in {r["ref"] for r in ladder.cascade(refs, titles).collect()}


def test_recogniser():
    text = "{{rh|1|A|}}'''A''', a ''b''<ref name=n>One {{sc|x}}</ref> [[C|d]]<ref name=n/>\n\n{|\n! H\n|-\n| rowspan=2 | 1 || 2\n|-\n| 3\n|}\n{{open"
    made = wikitext.produce(text)
    assert made.startswith("«B»A«/B», a «I»b«/I»«FN[n]:One «SC»x«/SC»«/FN» «LN:C|d«/LN»«FN[n]:One") and made.endswith("{{open")
    assert "«TABLE[cols:2]»«TR»«TH»H«/TH»«/TR»«TR»«TD[rowspan:2]»1«/TD»" in made and markers.dangling(made) == []
    assert [r[3] for r in wikitext.rows(wikitext.parse(text))][:4] == ["RUNNING_HEADER", "REF", "SMALL_CAPS", "WIKILINK"]
    assert wikitext.produce(None) is None and wikitext.produce("") == ""


def test_quotes():
    assert wikitext.quotes("''a'' '''b''' '''''c'''''") == "«I»a«/I» «B»b«/B» «I»«B»c«/B»«/I»"
    assert wikitext.quotes("L''''x'''") == "L'«B»x«/B»" and wikitext.quotes("''open") == "«I»open«/I»" and wikitext.quotes("it's") == "it's"


def test_constructs_and_parameters():
    assert wikitext.construct_end("{{a|{{b}}|[[c|d]]}} x", 0) == 19 and wikitext.construct_end("{{a", 0) == -1
    assert wikitext.construct_end("<b>x<b>y</b></b>z", 0) == 16 and wikitext.construct_end("<math>a</b></math>", 0) == 18
    assert wikitext.parameters("t|a|k = v|{{x|y}}") == ("t", ["a", "{{x|y}}"], {"k": "v"})
    assert wikitext.split_top("a|[[b|c]]|d") == ["a", "[[b|c]]", "d"] and wikitext.subpage("A/Bee#d") == "Bee#d"
    assert wikitext.decode_entities("&amp; &lt; &eacute; &#60;") == "& &lt; é &#60;"


def test_emitters():
    stream = "«TITLE:ABBEY«/TITLE»a «B»b«/B»«FN:note«/FN»«P»«UL»«LI»x«/LI»«LI»y«/LI»«/UL»«TABLE[cols:2]»«TR»«TD[colspan:2]»p|q«/TD»«/TR»«TR»«TD»r«/TD»«TD»s«/TD»«/TR»«/TABLE» <&> «MATH:a<b«/MATH» «I»open"
    md = markers.markdown(stream)
    assert "# ABBEY" in md and "**b**[^1]" in md and "[^1]: note" in md and "- x\n- y" in md and "| p\\|q |  |" in md and "«I»open" in md
    page = markers.to_html(stream)
    assert '<sup><a href="#fn1">1</a></sup>' in page and '<td colspan="2">p|q</td>' in page and "&lt;&amp;&gt;" in page
    from xml.etree import ElementTree

    ElementTree.fromstring(markers.tei(stream, "A & B", 1, "p. 1"))
    assert markers.markdown(None) is None and markers.to_html("") == ""


def test_crossing_and_sections():
    assert markers.crossing("«B»a«I»b«/B»c«/I»") == [("B", "I")] and markers.crossing("«B»a«I»b«/I»«/B»") == []
    assert markers.sections("«SEC:h|History»x«SH»Early«/SH»«ANCHOR:a|Name»") == [("sec", 1, "History"), ("sh", 2, "Early"), ("anchor", 3, "Name")]
    assert [x[:3] for x in markers.links("«LN:A|b«/LN» «AL:P, Q|«SC»q«/SC»«/AL» «LN:C|d»")] == [("link", "A", "b"), ("author", "P, Q", "q"), ("link", "C", "d")]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["«B»", "«/B»", "«I»", "«/I»", "text ", "«P»", "«FN:", "«/FN»", "«LN:a|b»", "{{", "<", "&", "«"]), max_size=12).map("".join))
def test_tei_is_always_well_formed(stream):
    from xml.etree import ElementTree

    ElementTree.fromstring(markers.tei(stream, "t"))


def test_keys_without_outer_dots(spark):
    for value, key in ((".-.", ""), ("A. -- .", "A"), ("St. Gall", "ST. GALL"), ("O’Neill.", "O'NEILL")):
        assert one(spark, value, X.xref_target) == key


def test_entities_are_decoded(spark):
    from lexiloom.functions import markup

    got = one(spark, "Smith &amp; Co &#233; &lt;b&gt; &vert;", markup.decode_entities)
    assert "Smith & Co é" in got and "&lt;b" in got and "&vert;" in got


def test_signatures_and_aliases(spark):
    for value, made in (("A.N.", "A. N."), ("T. F. T", "T. F. T."), ("✠ J. G.", "J. G."), ("O*.", "O.*"), ("C. {{sc|WI}}.", "C. Wi."), ("<small>H.</small>&thinsp;S..**", "H. S.*"), ("WI.", "Wi.")):
        assert one(spark, value, X.canonical_initials) == made, value
    assert one(spark, "Elizabeth  O’Neill", X.alias_form) == "Elizabeth O'Neill" and one(spark, "ﬁne “name”", X.alias_form) == 'fine "name"'


def test_leaks_by_format(spark):
    from lexiloom.functions.leaks import find_leaks

    cases = [
        ("html", '<p style="x">«B»a</p>', ["marker"]), ("html", "<p>&lt;ref name=x&gt;</p>", ["tag"]), ("html", "<p>: set in</p>", []), ("html", "<p>:set in</p>", ["indent"]), ("html", '<span class="math">{{a}}</span>', []),
        ("markdown", "$a}}$ [[x]]", ["wikilink"]), ("text", "align=left {{x}}", ["attr", "template"]), ("text", "a\x01b", ["sentinel"]), ("text", "a $b$", []), ("text", None, None),
    ]
    for fmt, value, expected in cases:
        got = one(spark, value, lambda c, fmt=fmt: find_leaks(c, fmt))
        assert got == expected, (fmt, value)


def test_furniture_templates_go_whole():
    assert wikitext.without_templates("a{{rh|1|{{sc|x}}|}}b{{C}}c{{XY Page Heading|{{{p}}}}}d<noinclude>{{rh|2}}e</noinclude>{{rh|open", ("rh", "c"), "page heading") == "abcd<noinclude>e</noinclude>{{rh|open"
