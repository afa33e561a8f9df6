import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom.operators import graph, intervals, resolve, search, sequence, votes
from lexiloom.operators.components import connected_components
from lexiloom.operators.ordered import last_known, next_known, running_sum
from lexiloom.operators.orphans import orphan_references
from lexiloom.operators.skew import hot_keys, left_join_unique


def test_left_join_survives_a_hot_key(spark):
    rows = [(1 if i % 3 == 0 else i, i) for i in range(3000)] + [(None, -1)]
    left = spark.createDataFrame(rows, "k long, v long")
    right = spark.createDataFrame([(1, "one"), (5, "five")], "k long, name string")
    assert hot_keys(left, "k", 0.1, 100) == [1]
    got = left_join_unique(left, right, "k", 0.1, 100)
    assert got.count() == len(rows) and got.where("name = 'one'").count() == 1001 and got.where("k IS NULL").first()["name"] is None
    assert hot_keys(left.limit(0), "k") == []


def test_components_agree_with_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(200 + i, 201 + i) for i in range(40)] + [(7, 7), (None, 3), (5, None)]
    parent = list(range(300))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    nodes = {x for u, v in edges if u is not None and v is not None and u != v for x in (u, v)}
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: min(x for x in nodes if root(x) == root(n)) for n in nodes}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_ordered_scans_over_blocks(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("ab"), i, rng.randrange(9), rng.choice([None, i])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, at int, n int, mark int")
    got = {r["at"]: r for r in running_sum(df, ["k"], ["at"], "n", "before", blocks=7).collect()}
    last = {r["at"]: r["last"] for r in last_known(df, ["k"], ["at"], F.col("mark"), "last", blocks=7).collect()}
    nxt = {r["at"]: r["next"] for r in next_known(df, ["k"], ["at"], F.col("mark"), "next", blocks=7).collect()}
    for k, at, _, _ in rows:
        same = [r for r in rows if r[0] == k]
        assert got[at]["before"] == sum(r[2] for r in same if r[1] < at)
        assert last[at] == max((r[3] for r in same if r[1] <= at and r[3] is not None), default=None)
        assert nxt[at] == min((r[3] for r in same if r[1] > at and r[3] is not None), default=None)
    assert running_sum(df.limit(0), ["k"], ["at"], "n", "before", blocks=3).count() == 0


def test_orphans_by_mask_and_semantics(spark):
    child = spark.createDataFrame(
        [(1, 10, "x", 5, "keep"), (2, 10, "z", 5, "keep"), (3, 10, None, 5, "keep"), (4, None, "z", 5, "keep"), (5, None, None, 5, "keep"), (6, 11, "y", 5, "keep"), (7, 12, "w", 5, "keep"), (7, 12, "w", 5, "keep"), (8, 12, "w", None, "keep")],
        "id long, a long, b string, loaded_at int, born string",
    )
    parent = spark.createDataFrame([(10, "x", 1, None), (11, "y", 1, None), (11, "y", 2, 9), (12, "w", 7, None), (None, "q", 1, None)], "ka long, kb string, loaded_at int, deleted_at int")

    def found(match, **kw):
        return sorted((r["id"], r["reason"]) for r in orphan_references(child, parent, ["a", "b"], ["ka", "kb"], match=match, **kw).collect())

    assert found("simple") == [(2, "missing"), (6, "deleted"), (7, "late"), (7, "late")]
    assert found("partial") == [(2, "missing"), (4, "missing"), (6, "deleted"), (7, "late"), (7, "late")]
    assert found("full") == [(2, "missing"), (3, "partial_null"), (4, "partial_null"), (6, "deleted"), (7, "late"), (7, "late")]
    out = orphan_references(child, parent, ["a", "b"], ["ka", "kb"])
    assert out.columns == [*child.columns, "reason"] and {r["born"] for r in out.collect()} == {"keep"}
    one = orphan_references(child, parent.limit(0), ["a"], ["ka"])
    assert one.count() == 7 and {r["reason"] for r in one.collect()} == {"missing"}
    assert orphan_references(child.limit(0), parent, ["a"], ["ka"]).count() == 0


def test_a_restored_key_is_not_deleted(spark):
    child = spark.createDataFrame([(1, 10, 5)], "id long, a long, loaded_at int")
    parent = spark.createDataFrame([(10, 1, None), (10, 2, 2), (10, 3, None)], "ka long, loaded_at int, deleted_at int")
    assert orphan_references(child, parent, ["a"], ["ka"]).count() == 0


def test_range_and_asof_joins(spark):
    rng = random.Random(1)
    spans = [(i, rng.choice("ab"), s := rng.randrange(50), s + rng.randrange(-2, 40)) for i in range(40)]
    points = [(i, rng.choice("ab"), rng.randrange(90)) for i in range(60)]
    a = spark.createDataFrame(spans, "id int, k string, lo int, hi int")
    b = spark.createDataFrame(points, "pid int, k string, at int")
    got = {(r["id"], r["pid"]) for r in intervals.range_join(a, b, ["k"], "lo", "hi", "at", 7).collect()}
    assert got == {(s[0], p[0]) for s in spans for p in points if s[1] == p[1] and s[2] <= p[2] <= s[3]}
    marks = spark.createDataFrame([(k, lo, i) for i, k, lo, _ in spans], "k string, m int, v int")
    seen = {r["pid"]: r["v"] for r in intervals.asof(b, marks, ["k"], "at", "m", "v", "v").collect()}
    for pid, k, at in points:
        before = [(lo, i) for i, kk, lo, _ in spans if kk == k and lo <= at]
        assert seen[pid] == (max(before)[1] if before else None)


def test_modes_break_ties_by_content(spark):
    df = spark.createDataFrame([("k", "b", 2), ("k", "a", 1), ("k", "b", 3), ("k", "a", 4), ("n", None, 1)], "k string, v string, at int")
    assert [(r["k"], r["m"], r["votes"]) for r in votes.mode(df, ["k"], "v", F.col("at"), "m").collect()] == [("k", "a", 4)]
    assert votes.unambiguous(df, "k", "v").count() == 0
    lines = spark.createDataFrame([("x",), ("y",), ("z",)], "l string")
    assert votes.merkle(lines, F.col("l")).first() == votes.merkle(lines.repartition(3), F.col("l")).first()


def test_sequence_kernels():
    assert sequence.advance(["A", "x", "B", "B", "A", "C"], [["A"], ["B"], ["C"]]) == [0, 0, 1, 1, 1, 2]
    assert sequence.spread_cells([[("a", 2, 1), ("b", 1, 2)], [("c", 1, 1)]]) == [["a", "b", ""], ["a", "c"]]
    text = "theabbeyandtheharbourandtheabbey"
    assert sequence.locate(text, ["theabbey", "theharbour", "theabbey"], [0, 11, 24]) == [0, 11, 24]
    assert sequence.clamp([None, 11, None], [3, 11, 99], 32) == [3, 11, 32]


def test_gap_filling_and_runs(spark):
    anchors = spark.createDataFrame([("v", 1, 10), ("v", 4, 12), ("v", 6, 99), ("v", 6, 98)], "k string, at int, n int")
    got = {r["at"]: r["n"] for r in sequence.fill_gaps(anchors, ["k"], "at", "n").collect()}
    assert got == {1: 10, 2: 11, 3: None, 4: 12}
    runs = spark.createDataFrame([("v", i, x) for i, x in enumerate([1, 1, None, None, 2, 1])], "k string, at int, n int")
    assert [r["island"] for r in sequence.islands(runs, ["k"], "at", "n", 3).orderBy("at").collect()] == [1, 1, 2, 2, 3, 4]


def test_rising_and_bins(spark):
    df = spark.createDataFrame([("v", i, x) for i, x in enumerate([1, 2, 90, 3, 4, 2, 5])], "k string, at int, n int")
    kept = [r["kept"] for r in sequence.rising(df, "k", "at", "n", "k string, at int, n int, kept boolean").orderBy("at").collect()]
    assert kept == [True, True, False, True, True, False, True]
    bins = [r["bin"] for r in sequence.greedy_bins(df, "k", "at", "n", 5, "k string, at int, n int, bin int").orderBy("at").collect()]
    assert bins == [0, 0, 1, 2, 3, 4, 5]


@given(st.lists(st.integers(0, 10**9), max_size=20))
def test_postings_round_trip(numbers):
    assert search.unvarint("".join(map(search.varint, numbers))) == numbers


def test_outline_parents_and_trees(spark):
    df = spark.createDataFrame([("v", i, lv, i) for i, lv in enumerate([0, 1, 2, 2, 1, 0, 2])], "k string, at int, level int, id int")
    got = {r["id"]: r["parent"] for r in graph.parents_by_level(df, ["k"], "at", "level", "id").collect()}
    assert got == {0: None, 1: 0, 2: 1, 3: 1, 4: 0, 5: None, 6: 5}
    nodes = spark.createDataFrame([("a", None, "A"), ("b", "a", "B"), ("c", "b", "C"), ("x", "gone", "X")], "id string, parent string, name string")
    assert {r["id"]: r["path"] for r in graph.flatten(nodes).collect()} == {"a": "A", "b": "A/B", "c": "A/B/C"}


def test_pickers_abstain(spark):
    rows = [("r1", "a", 0.9, 1), ("r1", "b", 0.5, 0), ("r2", "a", 0.9, 0), ("r2", "b", 0.89, 0), ("r3", "c", 0.1, 0)]
    df = spark.createDataFrame(rows, "ref string, title string, s double, k int")
    assert [r["ref"] for r in resolve.best_by_margin(df, "ref", "title", "s", 0.45, 0.02).collect()] == ["r1"]
    got = {r["ref"]: (r["title"], r["method"]) for r in resolve.fish(df, "ref", "title", [("kind", F.col("k")), ("score", F.round("s", 1))]).collect()}
    assert got == {"r1": ("a", "kind"), "r2": (None, "abstain"), "r3": ("c", "score")}
    assert {r["ref"] for r in resolve.only(df, "ref", F.col("k") == 1).collect()} == {"r1"}


def test_unique_ids_are_unique(spark):
    rng = random.Random(3)
    for _ in range(3):
        rows = [(i, rng.choice("abc"), rng.choice("axyz") + "-") for i in range(14)]
        df = spark.createDataFrame(rows, "id int, base string, other string")
        made = [r["made"] for r in sequence.unique_ids(df, "base", "other", ["id"], "made").collect()]
        assert len(made) == len(rows) == len(set(made))


def chains(text, signs, expected):
    """All chains by brute force: the greatest number placed, then the least distance."""
    best = (0, 0)
    found = [[i for i in range(len(text)) if s and text.startswith(s, i)] for s in signs]

    def walk(at, last, placed, cost):
        nonlocal best
        if at == len(signs):
            best = min(best, (-placed, cost))
            return
        walk(at + 1, last, placed, cost)
        for p in found[at]:
            if p >= last:
                walk(at + 1, p, placed + 1, cost + abs(p - expected[at]))

    walk(0, 0, 0, 0)
    return best


@settings(max_examples=200, deadline=None)
@given(st.text("ab", max_size=12), st.lists(st.tuples(st.text("ab", max_size=2), st.integers(0, 12)), max_size=5))
def test_places_are_the_best_chain(text, wanted):
    signs, expected = [w[0] for w in wanted], [w[1] for w in wanted]
    got = sequence.locate(text, signs, expected)
    placed = [(p, e) for p, e in zip(got, expected) if p is not None]
    assert all(text.startswith(s, p) for s, p in zip(signs, got) if p is not None)
    assert [p for p, _ in placed] == sorted(p for p, _ in placed)
    assert (-len(placed), sum(abs(p - e) for p, e in placed)) == chains(text, signs, expected)


def test_a_far_page_is_placed_all_the_same():
    text = "x" * 20_000 + "theabbey"
    assert sequence.locate(text, ["theabbey"], [0]) == [20_000] and sequence.locate("", ["a", ""], [0, 0]) == [None, None]


@given(st.lists(st.one_of(st.none(), st.integers(0, 9)), max_size=12))
def test_reachable(values):
    for i, (v, fine) in enumerate(zip(values, sequence.reachable(values))):
        later = values[i + 1 :]
        assert fine == (v is not None and 2 * sum(x is not None and x >= v for x in later) >= len(later))


def test_previous_over_blocks(spark):
    from lexiloom.operators.ordered import previous

    df = spark.range(200).selectExpr("CASE WHEN id % 5 = 0 THEN 'rare' ELSE 'hot' END AS k", "id")
    got = {(r["k"], r["id"]): r["p"] for r in previous(df, ["k"], ["id"], "id", "p", blocks=7).collect()}
    for k in ("rare", "hot"):
        ids = sorted(i for kk, i in got if kk == k)
        assert [got[k, i] for i in ids] == [None, *ids[:-1]]


def test_outlines_of_any_depth_and_circles(spark):
    rows = [("a", i, i % 12, f"n{i}") for i in range(60)] + [("a", 60, None, "last")]
    df = spark.createDataFrame(rows, "k string, at int, level int, id string")
    got = {r["id"]: r["parent"] for r in graph.parents_by_level(df, ["k"], "at", "level", "id").collect()}
    for _, i, level, name in rows[:-1]:
        before = [n for _, j, l, n in rows[:i] if l < level]
        assert got[name] == (before[-1] if before else None)
    assert got["last"] == "n59"
    deep = spark.createDataFrame([(str(i), str(i - 1) if i else None, "n") for i in range(70)] + [("x", "y", "x"), ("y", "x", "y")], "id string, parent string, name string")
    assert graph.flatten(deep).count() == 70


def test_valid_rows_are_whole(spark, tmp_path):
    from datetime import datetime

    from lexiloom.plans.common import valid

    at = datetime(2024, 1, 1)
    rows = [(1, "a", 1, "x", at, None), (1, "b", 2, "y", at, None), (2, "c", 3, "old", at, None), (2, "d", 4, None, datetime(2024, 2, 1), None), (3, "e", 5, "z", at, at), (None, "f", 6, "n", at, None)]
    spark.createDataFrame(rows, "id long, title string, volume int, body string, loaded_at timestamp_ntz, deleted_at timestamp_ntz").write.parquet(str(tmp_path / "articles.parquet"))
    got = {r["id"]: (r["title"], r["volume"], r["body"]) for r in valid(spark, str(tmp_path)).collect()}
    assert got[1] in {("a", 1, "x"), ("b", 2, "y")} and got[2] == ("d", 4, None) and set(got) == {1, 2}


def test_ingest_appends_and_may_be_run_again(spark, tmp_path):
    from lexiloom.streaming import events as S

    source, target, state = (str(tmp_path / n) for n in ("source", "target", "state"))
    schema = "id long, v string"
    for batch in ([(1, "a"), (1, "b"), (2, "c")], [(2, "new"), (3, "d")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        S.ingest(spark.readStream.schema(schema).parquet(source), target, ["id"], state)
    got = {r["id"]: (r["v"], r["batch"]) for r in spark.read.parquet(target).collect()}
    assert got[1][0] in ("a", "b") and got[2] == ("c", 0) and got[3] == ("d", 1)
