"""Cases that the operators once lost."""

import random


def test_variants_of_a_common_surname_are_linked(spark):
    from lexiloom.llm import people

    firsts = "Bernard Clement Douglas Ernest Frederick Gilbert Herbert Isaac Kenneth Leonard Maurice Norman Oliver Percival Quentin Reginald Stephen Theodore Ursula Vincent Walter Xavier".split()
    rows = [(i, f"{f} Smith", None, None, None) for i, f in enumerate(firsts)]
    rows += [(100, "John Smith", "F.L.S.", "ferns", None), (101, "John Arthur Smith", "F.L.S.", "ferns", None), (102, "SMITH, J.", "FLS", "ferns", None), (103, "John A. Smyth", "F.L.S.", "ferns", None), (104, "John Smith", "M.A.", "coins", None)]
    draw = random.Random(1)
    rows += [(200 + i, f"{draw.choice(firsts)} {''.join(draw.choices('bcdefghiklmnoprstuvw', k=9))}", None, None, None) for i in range(400)]
    df = spark.createDataFrame(rows, "rid long, name string, letters string, field string, signature string")
    linked = {r["rid"]: r["entity"] for r in people.link_names(df).collect()}
    assert [linked[i] for i in (100, 101, 102, 103, 104)] == [100, 100, 100, 100, 104]
    assert all(linked[i] == i for i in range(len(firsts)))


def scanned(spark, lines):
    return spark.createDataFrame([(1, 1, 1, "raw_text", "\n".join(lines))], "page_id long, volume int, page_number int, field_name string, text string")


def test_a_misread_form_of_the_fifth_form_of_its_group(spark):
    from lexiloom.llm import scan

    frequent = ["soil", "soll", "sorl", "sori", "son"]
    assert len({scan.skeleton(w) for w in [*frequent, "sou"]}) == 1
    n = {w: 9000 - i for i, w in enumerate(frequent[:4])} | {"son": 600, "sou": 10}
    counted = spark.createDataFrame([("word", w, k) for w, k in n.items()], "kind string, word string, n long")
    expected = {(w, r) for w in n for r in n if w != r and scan.may_misread(w, n[w], r, n[r])}
    assert ("sou", "son") in expected and {r for w, r in expected if w == "sou"} == {"son"}, expected
    maybe = scan.candidates(counted)
    assert {(r["word"], r["right"]) for r in maybe.collect()} == expected
    contexts = spark.createDataFrame([], "side string, word string, other string, n long")
    assert ("sou", "son") in {tuple(r) for r in scan.misread_forms(maybe, contexts).collect()}


def test_words_beyond_the_most_frequent_may_be_contested(spark, monkeypatch):
    from lexiloom.llm import scan

    monkeypatch.setattr(scan, "FREQUENT", 3)
    lines = ["but it had fallen on some of the great old"] * 60 + ["see if the merchants of the great old"] * 60 + ["but if had fallen on some of the great old"]
    found, _, _ = scan.noise(scanned(spark, lines))
    assert (121, "misread") in {(r["line_no"], r["kind"]) for r in found.collect()}
