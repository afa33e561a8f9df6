from hypothesis import given, settings
from hypothesis import strategies as st

from lexiloom.llm.headings import Canon, Trie, TwoWay, candidates, map_to_list, unwrap
from lexiloom.llm.names import edits

LIST = [
    (1, "CONDOLA", "place"), (2, "TAMBURT (RIVER)", "place"), (3, "TAMBURT (TOWN)", "place"), (4, "GROSSIKA, DUCHY OF", "place"), (5, "SAINT ZESKELMUR", "biography"),
    (6, "PRONDIROBREC, FREDERICK", "biography"), (7, "ALPINE MACHINERY", "subject"), (8, "FARDELERLEY, AUGUSTUS JOSÉ", "biography"), (9, "PRONDIROBREC, HUGH", "biography"),
]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=7), max_size=25), st.text("abc", max_size=7), st.integers(1, 3))
def test_the_automaton_finds_all_within_the_distance(paths, word, most):
    expected = {i: edits(word, p, most) for i, p in enumerate(paths)}
    for trie in (Trie(), TwoWay()):
        for i, p in enumerate(paths):
            trie.add(p, i)
        assert {v: d for d, v in trie.near(word, most)} == {i: d for i, d in expected.items() if d <= most}


def test_unwrap():
    assert unwrap("«LN:Condola|condola»") == "Condola" and unwrap("(see also Condola)") == "Condola"
    assert unwrap("v. Condola: Trade") == "Condola" and unwrap(" condola (q.v.)").strip() == "condola" and unwrap("See X#History") == "X"


def test_what_values_mean():
    canon = Canon.of(LIST)
    means = {
        ("CONODLA", None): 1, ("Cón\xaddola", None): 1, ("the city of Condola", None): 1, ("condola#trade", None): 1, ("CONDOLA ISLANDS", None): 0, ("Lake Condola", None): 0,
        ("Condola (River)", None): 0, ("River Tamburt", None): 2, ("tambrut t.", None): 3, ("Tamburt (tow.)", None): 3, ("TAMBURT ", "«LN:Tamburt (Town)|x»"): 3, ("the duchy of Grossika", None): 4,
        ("Grossika, Duch. of", None): 4, ("Grossika, Kingdom of", None): 0, ("St. Zeskelmur", None): 5, ("Zeskelmur, Saint", None): 5, ("Sir Frederick Prondirobrec", None): 6, ("prondirobrec, f.", None): 6,
        ("Prondirobrec, Hugh", None): 9, ("Prondirobrec, William", None): 0, ("Machinery, Alpine", None): 7, ("the Alpine-Machinery", None): 7, ("A. J. Fardelerley", None): 8, ("FARDELERLEY, Augs. José", None): 8,
        ("FARDEL", None): 8, (None, "see Condola"): 1, ("ibid.", None): 0, ("p. 283", None): 0, ("", ""): 0, (None, None): 0, ("x" * 5000, None): 0, ("§", "(see )"): 0,
    }
    assert {k: canon.resolve(*k) for k in means} == means


def test_mapping_rows(spark):
    headings = spark.createDataFrame([*LIST, (None, "NOTHING", None), (20, None, "place")], "heading_id long, heading string, category string")
    rows = [(1, "CONODLA", None, 5), (1, "CONODLA", None, 5), (2, None, None, None), (3, None, "v. Grossika, Duchy of", 7), (None, "ibid.", "", 0)]
    df = spark.createDataFrame(rows, "id long, normalized string, surface string, heading_id int")
    expected = sorted([(1, 1), (1, 1), (2, 0), (3, 4), (None, 0)], key=str)
    for most in (100, 2):  # at once, and in several passes
        out = map_to_list(df, "normalized", "surface", headings, most_entries=most)
        assert sorted(((r["id"], r["heading_id"]) for r in out.collect()), key=str) == expected
    assert map_to_list(df.limit(0), "normalized", "surface", headings).count() == 0
    assert {r["heading_id"] for r in map_to_list(df, "normalized", "surface", headings.limit(0)).collect()} == {0}


def test_parts_of_a_list_are_compared_by_cost(spark):
    headings = spark.createDataFrame([(1, "BERLINS", "place"), (2, "BERLIN", "place"), (3, "PARIS", "place")], "heading_id long, heading string, category string")
    df = spark.createDataFrame([(1, "BERLIN ", None), (2, "Berlyn", ""), (3, "", "pariss"), (4, "Berli", "Berlin (q.v.)"), (5, None, None)], "id long, n string, s string")
    at_once = sorted((r["id"], r["heading_id"]) for r in map_to_list(df, "n", "s", headings).collect())
    assert at_once == [(1, 2), (2, 2), (3, 3), (4, 2), (5, 0)]
    for most in (1, 2):
        assert sorted((r["id"], r["heading_id"]) for r in map_to_list(df, "n", "s", headings, most_entries=most).collect()) == at_once


def test_a_hot_pair_keeps_all_its_rows(spark):
    headings = spark.createDataFrame([(1, "BERLIN", "place")], "heading_id long, heading string, category string")
    df = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 7 = 0 THEN concat('x', id) ELSE 'berlin' END AS n", "CASE WHEN id % 2 = 0 THEN '' END AS s")
    got = map_to_list(df, "n", "s", headings)
    assert got.count() == 5000 and got.where("heading_id = 1").count() == df.where("n = 'berlin'").count()


def test_all_entries_within_the_distance(spark):
    headings = spark.createDataFrame([(1, "BERLINS", "place"), (2, "BERLIN", "place"), (3, "PARIS", "place"), (4, "MERLIN", "place")], "heading_id long, heading string, category string")
    df = spark.createDataFrame([("Berlin",), ("Berlin",), ("berlyn",), (None,), ("",), ("nothing near",)], "v string")
    expected = {("Berlin", 1, 1), ("Berlin", 2, 0), ("Berlin", 4, 1), ("berlyn", 2, 1)}
    for most in (10, 2):
        got = candidates(df, "v", headings, most_entries=most).collect()
        assert {tuple(r) for r in got} == expected and len(got) == len(expected)
