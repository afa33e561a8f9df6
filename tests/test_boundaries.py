"""Articles are cut out of pages at title blocks."""

import pytest

from lexiloom.kernel import boundaries
from lexiloom.operators.boundaries import walk_volumes


def articles(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, volume int, page_number int, text string")
    return {r["title"]: r for r in walk_volumes(df).collect()}


def test_sections_and_continuations(spark):
    pages = [
        (1, 1, 40, "<section begin=\"Lantern\" />'''LANTERN,'''\nA case for a light.\n\n<section begin=\"Larch\" />'''LARCH,'''\nA tree that sheds its needles."),
        (2, 1, 41, "More is said of the tree on this page."),
        (3, 1, 42, "<section begin=\"Lathe\" />'''LATHE,''' A machine for turning."),
        (4, 2, 1, "What no heading leads is no article's."), (5, 2, 2, None), (6, 2, 3, ""), (7, None, 3, "'''LOST'''"),
    ]
    got = articles(spark, pages)
    assert set(got) == {"LANTERN", "LARCH", "LATHE"}
    assert (got["LANTERN"]["page_start"], got["LANTERN"]["page_end"]) == (40, 40) and "light" in got["LANTERN"]["body"]
    larch = got["LARCH"]
    assert (larch["page_start"], larch["page_end"]) == (40, 41) and "needles" in larch["body"] and "More is said" in larch["body"]
    assert [s["page_id"] for s in larch["segments"]] == [1, 2] and larch["body"][larch["segments"][1]["body_offset"] :].startswith("More is said")
    assert (got["LATHE"]["page_start"], got["LATHE"]["page_end"]) == (42, 42)
    assert articles(spark, pages[:0] + [(1, 1, 1, None)]) == {}


def test_several_articles_on_a_page_and_layout_before_a_heading(spark):
    page = "<noinclude>{{rh|1|X|}}</noinclude>\n{{c|{{sc|Fig.}} {{lh|88%|1}}}}\n«B»MADDER«/B>, none\n\n{|\n| a\n|}\n«B»MAGNET«/B», text\n\n[[File:a.png|x]]\n«B»MAIZE«/B», text. In «B»BOLD«/B» print.\n\n<section begin=\"N\"/>{{dropinitial|N}} the letter"
    assert set(articles(spark, [(1, 1, 1, page)])) == {"MAGNET", "MAIZE", "N"}


@pytest.mark.parametrize("raw", ["LANTERN", "McPHERSON, JOHN", "X RAYS", "{{sc|lantern}}", "LANTERN (LIGHT)", "CIVIL", "UR"])
def test_titles(raw):
    assert boundaries.is_title(raw.replace(", JOHN", ", JOHN"))


@pytest.mark.parametrize("raw", ["IV.", "PART II", "1. Early", "C6H5", "A", "Sub-class. TRILOBITA", "A. Rhachitomi", "ORDER I. BIRDS", "", "lantern"])
def test_no_titles(raw):
    assert not boundaries.is_title(raw)


def test_an_open_template_hides_what_follows():
    assert boundaries.title_blocks("{{c|open\n«B»LANTERN«/B»") == []
