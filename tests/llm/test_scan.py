from lexiloom.llm import scan

TEXT = ["When the kiln was described three travellers of broad", "workmanship came to light under the cross-", "shaped roof of the old and well-known har-", "bour, and thc market was much enlarged by", "the cross-shaped and well-known canal there."]


def test_page_edges():
    page = scan.Page("\n".join(["Digitized for the Reading Room", "29          Vounthuline    ", "", *TEXT, "HISTORY", *TEXT, "until 1462.", "- 31 -", "~ ' . , -"]))
    assert sorted(page.sure) == [0, 1, 15, 16] and page.maybe == {8: ("HISTORY", False)}
    page = scan.Page("\n".join(["{{rh||KONTHALTOLA|37}}", *TEXT, "1449."]))
    assert page.sure == {0} and 6 in page.text
    page = scan.Page("\n".join(["VOURNECKOWICK", *TEXT, "TRADE] SELONDALE       xi", *TEXT]))
    assert page.maybe[0] == ("VOURNECKOWICK", True) and 6 in page.sure
    assert scan.Page("").text == [] and scan.Page(" \n\t").text == []


def test_odd_words():
    assert all(scan.odd(w) for w in ("g1ass", "ſtill", "l809", "w@s", "ﬁrst", "l5th", "lO"))
    assert not any(scan.odd(w) for w in ("13th", "1845", "well-known", "40,316", "Théodore", "II", "K.C", "his"))


def test_misreadings():
    assert scan.confusions("tlie", "the") == 1 and scan.confusions("rnodcrn", "modern") == 2 and scan.confusions("house", "mouse") > 3
    assert scan.may_misread("tlie", 5, "the", 900) and not scan.may_misread("thinis", 13, "thulis", 23) and not scan.may_misread("it", 300, "if", 800)
    for size in (1, 2, 10, 100):  # by rate, whatever the size
        assert scan.may_misread("tlien", size, "then", 3 * size) and not scan.may_misread("tlien", size, "then", 2 * size)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, volume int, page_number int, field_name string, text string")


def test_noise_and_paragraphs(spark):
    first = "\n".join(["VOURNECKOWICK   1", *TEXT, "", "   The last word of this page is cut in the mid-"])
    second = "\n".join(["SCANNED BY THE LIBRARY", "2  KONTHALTOLA", "dle of it.", *TEXT * 30])
    rows = [(1, 1, 1, "raw_text", first), (1, 1, 1, "raw_text", first), (2, 1, 2, "raw_text", second), (3, 1, 3, "raw_text", None), (4, 1, 4, "raw_text", ""), (5, 1, 5, "wikitext", " \n ")]
    found, wrong, _ = scan.noise(pages(spark, rows))
    got = {tuple(r) for r in found.collect()}
    assert {x for x in got if x[0] == 1} == {(1, "raw_text", 1, "furniture"), (1, "raw_text", 4, "hyphen"), (1, "raw_text", 8, "hyphen")}
    assert {(2, "raw_text", 1, "furniture"), (2, "raw_text", 2, "furniture")} <= got and not any(x[0] > 2 for x in got)
    assert not any(k == "hyphen" and n == 5 for p, f, n, k in got)
    parts = scan.paragraphs(pages(spark, rows)).orderBy("first_page", "paragraph_no").collect()
    assert len(parts) == 2 and "harbour" in parts[0]["text"] and "cross-shaped roof" in parts[0]["text"]
    assert parts[1]["text"].startswith("The last word of this page is cut in the middle of it. When") and parts[1]["last_page"] == 2
    assert scan.noise(pages(spark, rows).limit(0))[0].count() == 0


def test_frequent_form_wins(spark):
    text = "\n".join(["the market and the canal of the harbour"] * 30 + ["tlie market and thc canal"])
    _, wrong, _ = scan.noise(pages(spark, [(1, 1, 1, "raw_text", text)]))
    assert {tuple(r) for r in wrong.collect()} == {("tlie", "the"), ("thc", "the")}
    assert scan._mended("«Tlie,", {"tlie": "the"}) == "«The,"


def test_neighbours_decide_between_frequent_words(spark):
    lines = ["but it had fallen"] * 60 + ["see if the merchants"] * 60 + ["but if had fallen"] + ["and it goes if well"]
    found, wrong, _ = scan.noise(pages(spark, [(1, 1, 1, "raw_text", "\n".join(lines))]))
    assert wrong.count() == 0 and {(r["line_no"], r["kind"]) for r in found.collect()} == {(121, "misread")}


def test_contexts_decide_between_a_misreading_and_a_word(spark):
    """Of two forms at one to three, the one in the contexts of the other is a misreading and the one in its own is a word."""
    lines = [f"they saw then {w} hills" for w in ("many", "some", "few")] * 20 + [f"they saw tlien {w} hills" for w in ("many", "some", "few")] * 6
    lines += [f"a loaf of {w} for all" for w in ("bread", "bread", "rye")] * 20 + [f"some broad {w} lay south" for w in ("bread", "valley", "river")][1:] * 12
    lines += ["the broad road lay south", "its broad valley was green", "one broad river ran down"] * 6
    found, wrong, _ = scan.noise(pages(spark, [(1, 1, 1, "raw_text", "\n".join(lines))]))
    assert {tuple(r) for r in wrong.collect()} == {("tlien", "then")}
    assert {lines[r["line_no"] - 1].split()[2] for r in found.collect() if r["kind"] == "misread"} == {"tlien"}


def test_support():
    assert scan.supported(0, 2, 0.9) and scan.supported(0, 0, 0.9)  # two contexts cannot speak against it
    assert not scan.supported(0, 200, 0.9) and scan.supported(150, 200, 0.9) and not scan.supported(30, 200, 0.9)


def test_dividing_a_page():
    text = "goes on\nhere and\n12\n\n  A new para-\ngraph of tlie well-\nknown"
    assert scan.divide(text, [3], [5], [{"line_no": 6, "key": "tlie", "right": "the"}]) == [
        {"starts": False, "piece": "goes on here and "}, {"starts": True, "piece": "A new paragraph of the well-known "},
    ]
    assert scan.divide(" \n", [], [], []) == []


def test_paragraphs_go_on_over_pages(spark):
    rows = [(1, 1, 1, "raw_text", "before any beginning"), (2, 1, 2, "raw_text", "still before\n\nFirst begins here"), (3, 1, 3, "raw_text", "and goes"), (4, 1, 4, "raw_text", "on to here.\n\nSecond.\n\nThird"), (5, 2, 1, "raw_text", "Another volume.")]
    got = {(r["volume"], r["first_page"], r["paragraph_no"], r["last_page"], r["text"]) for r in scan.paragraphs(pages(spark, rows)).collect()}
    assert got == {
        (1, 1, 0, 2, "before any beginning still before"), (1, 2, 1, 4, "First begins here and goes on to here."), (1, 4, 1, 4, "Second."), (1, 4, 2, 4, "Third"), (2, 1, 0, 1, "Another volume."),
    }
