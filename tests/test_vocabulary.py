"""The labels of the recogniser and what their producers make."""

import pytest

from lexiloom.kernel import markers, styles, wikitext


@pytest.mark.parametrize(
    ("source", "label", "made"),
    [
        ("{{cite|The History}}", "CITE", "«I»The History«/I»"), ("{{lb-|20}}", "LB", "20 lb"), ("{{main other|shown|hidden}}", "MAIN_OTHER", "shown"), ("{{{name|by default}}}", "PARAM_DEFAULT", "by default"),
        ("{{{name}}}", "PARAM_DEFAULT", "{{{name}}}"), ("{{fs|108%|words}}", "PARAM", "«SPAN[style:font-size:108%]»words«/SPAN»"), ("{{dual line|upper|lower}}", "DUAL_LINE", "upper«BR»lower"),
        ("{{brace2|3|r}}", "BRACE", "}"), ("{{hieroglyph|A1}}", "HIEROGLYPH", "«HIERO:A1«/HIERO»"), ("{{reflist}}", "REFS", ""), ("<references/>", "REFS", ""), ('<pagequality level="3" user="x"/>', "PAGEQUALITY", ""),
        ("{{equation|x^2|(15)}}", "MATH_EQUATION", "«EQN[15]:x^2«/EQN»"), ("{{ne||E {{=}} m|(2).}}", "MATH_EQUATION", "«EQN[2]:E = m«/EQN»"), ("{{toc row|Chapter|12}}", "TOC_ROW", "Chapter … 12"),
        ("{{some footer|J. S.}}", "CONTRIBUTOR_FOOTER", "«SIGN»J. S.«/SIGN»"), ("{{CE lkpl|Abbey|the abbey}}", "TARGET_FIRST_LINK", "«LN:Abbey|the abbey«/LN»"), ("[[#Trade|see below]]", "FRAGMENT_LINK", "«LN:#Trade|see below«/LN»"),
        ("{{an intra-article link|Trade}}", "INTRA_ARTICLE_LINK", "«LN:#Trade|Trade«/LN»"), ("{{1\\over 2}}", "FRACTION", "1/2"), ("{{abbr|St.|Saint}}", "CONTENT_EXTRACT", "St."), ('<span title="say">word</span>', "SPAN_TITLE", "word"),
        ('<div style="color:red">word</div>', "HTML_STYLE", "«DIV[style:color:red]»word«/DIV»"), ("{{shy}}", "SPACER", "\xad"), ("{{hws|mid|middle}}", "SPLIT_WORD", ""), ("{{lpe|dle|middle}}", "SPLIT_WORD", "middle"),
        ("{{c/s}}a {{sc|b}}{{c/e}}", "PAIRED_WRAPPER", "«CTR»a «SC»b«/SC»«/CTR»"), ("{{uc|abc}}", "UPPER_CASE", "ABC"), ("{{no such thing|x}}", "DOUBLE_BRACE_LEAK", "{{no such thing|x}}"),
    ],
)
def test_labels(source, label, made):
    tree = wikitext.parse(source)
    assert [c.label for c in tree.children if isinstance(c, wikitext.Element)] == [label]
    assert wikitext.produce(source) == made


def test_charts_are_images_with_their_notes():
    made = wikitext.produce("Before {{familytree/start}}{{familytree|a|b=<ref>a note</ref>}}<ref>of it</ref>{{familytree/end}} after.")
    assert made.startswith("Before {{IMG:familytree.jpg|Genealogical table}}") and "«FN:of it«/FN»" in made and "/start" not in made and made.endswith("after.")


def test_halves_without_a_partner_are_marks():
    labels = [c.label for c in wikitext.parse("{{c/s}}a {{fine block/e}}").children if isinstance(c, wikitext.Element)]
    assert labels == ["WRAP_OPEN", "WRAP_CLOSE"]
    assert wikitext.produce("x {{c/e}} y") == "x «/CTR» y"


def test_lines_set_in_and_lists():
    text = "Before\n: set in {{c|x\n: y}}\n:: deeper\n# one\n# two\nAfter: not"
    tree = wikitext.parse(text)
    labels = [c.label for c in tree.children if isinstance(c, wikitext.Element)]
    assert labels == ["INDENT", "INDENT", "LIST"]
    made = wikitext.produce(text)
    assert "«DIV[indent:1]»set in" in made and "«DIV[indent:2]»deeper«/DIV»" in made and "«OL»«LI»one«/LI»«LI»two«/LI»«/OL»" in made and made.endswith("After: not")
    assert "1. one" in markers.markdown(made)


def test_equation_labels():
    assert [wikitext.equation_label(x) for x in ("(15)", "«BR»(15)«I»a«/I»", "(2).", "[3]", "")] == ["15", "15", "2", "3", ""]


def test_notes_named_follow_and_reuse():
    made = wikitext.produce('A<ref name="n">first</ref> b<ref name="n"/> c<ref follow="n">and more</ref> d<ref>other</ref>.')
    assert made == "A«FN[n]:first and more«/FN» b«FN[n]:first and more«/FN» c d«FN:other«/FN»."
    assert markers.markdown(made) == "A[^1] b[^1] c d[^2].\n\n[^1]: first and more\n[^2]: other"


def test_style_codes():
    cases = {
        "ar": "text-align:right", "Centre": "text-align:center", "bl": "border-left:1px solid", "bt3": "border-top:3px solid", "bad": "border:4px double", "bbd": "border-bottom:4px double", "br2.": "border-right:2px dotted",
        "btt": "border-top:0px solid transparent", "blt1": "border-left:1px solid transparent", "h33": "height:calc(100% / 3)", "w0": "width:0", "w95": "width:95%", "wmax": "width:max-content", "mt5": "margin-top:5px",
        "ma10": "margin:10px", "lh110": "line-height:110%", "fs083": "font-size:83%", "p.5": "padding:0.5em", "p0": "padding:0", "plr0": "padding-left:0em; padding-right:0em", "ptb1.5": "padding-top:1.5em; padding-bottom:1.5em",
        "pl3.5": "padding-left:3.5em", "it1p2": "padding-left:3em; text-indent:-1em", "itp.5": "padding-left:2.5em; text-indent:-2em", "sm": "font-size:83%", "zz": None, "p": None,
    }
    assert {c: styles.css(c) for c in cases} == cases
    assert styles.rules("ar|zz|bb2") == "text-align:right;border-bottom:2px solid" and styles.rules(None) is None
