import math
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom.llm.pack import best_fit, byte_pieces, cut_bytes, pack


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=40))
def test_best_fit_keeps_every_item_and_the_capacity(sizes):
    bins = best_fit(sizes, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 50 for b in bins)
    assert sum(sum(sizes[i] for i in b) <= 25 for b in bins) <= 1


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 10), min_size=1, max_size=6))
def test_best_fit_is_near_the_least(sizes):
    least = min(len(set(homes)) for homes in product(range(len(sizes)), repeat=len(sizes)) if all(sum(s for s, h in zip(sizes, homes) if h == b) <= 10 for b in set(homes)))
    assert len(best_fit(sizes, 10)) <= math.ceil(11 / 9 * least + 1)


@given(st.text(alphabet="aé漢𐤀 ", min_size=1, max_size=60))
def test_cut_bytes_spells_the_text(text):
    pieces = cut_bytes(text, 7)
    assert "".join(text[s:e] for _, s, e, _ in pieces) == text
    assert all(len(text[s:e].encode()) == n <= 7 for _, s, e, n in pieces)
    assert all(n >= 4 for _, _, _, n in pieces[:-1])


def test_rounds_merge_what_is_left(spark):
    sizes = [(i, (i * 37) % 90 + 5) for i in range(400)]
    df = spark.createDataFrame([*sizes, (1000, None), (1001, 0)], "item long, size int")
    out = pack(df, ["item"], "size", 100, per_task=60).collect()
    assert sorted(r["item"] for r in out) == [*range(400), 1001]
    fills = {}
    for r in out:
        fills[r["container_id"]] = fills.get(r["container_id"], 0) + max(1, r["size"])
    assert all(v <= 100 for v in fills.values()) and all(fills[r["container_id"]] == r["container_fill"] for r in out)
    assert len(fills) <= 1.08 * math.ceil(sum(s for _, s in sizes) / 100)
    assert pack(df.limit(0), ["item"], "size", 100).count() == 0
    with pytest.raises(Exception, match="exceeds"):
        pack(spark.createDataFrame([(1, 101)], "item long, size int"), ["item"], "size", 100).count()


def test_byte_pieces(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "é" * 4), (4, "é" * 12)], "id long, body string")
    got = {r["id"]: r["p"] for r in df.select("id", byte_pieces(F.col("body"), 10).alias("p")).collect()}
    assert got[1] is None and got[2][0]["piece_bytes"] == 0 and len(got[3]) == 1
    assert [p["piece_bytes"] for p in got[4]] == [10, 10, 4]


def test_ids_of_several_columns_and_items_that_do_not_fit_together(spark):
    df = spark.createDataFrame([(a, b, 60) for a in range(40) for b in range(3)], "a long, b int, size int")
    out = pack(df, ["a", "b"], "size", 100, per_task=10).collect()
    assert sorted((r["a"], r["b"]) for r in out) == [(a, b) for a in range(40) for b in range(3)]
    assert len({r["container_id"] for r in out}) == 120 and all(r["container_id"] == f"{r['a']}/{r['b']}" for r in out)
