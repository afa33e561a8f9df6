import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiloom.llm.split import Boundaries, split_oversized, split_text

TEXT = st.lists(st.sampled_from(["word ", "end. ", "«P»", "\n\n", "\n \n", "x" * 37, "\t", "Who? ", "é𐤀 "]), max_size=120).map("".join)


@settings(max_examples=150, deadline=None)
@given(TEXT, st.integers(20, 80))
def test_pieces_cover_the_text_within_the_limit(text, limit):
    _, spans = split_text(text, limit, limit // 4)
    reached = 0
    for start, end, cut in spans:
        assert end - start <= limit and start <= reached
        if cut in ("paragraph", "sentence", "word"):
            assert not text[end - 1].isspace()
        reached = max(reached, end)
    assert not text[reached:].strip()
    assert [s for s, _, _ in spans] == sorted({s for s, _, _ in spans})


def brute_division(text, limit):
    import re

    plain = text.replace("«P»", "\n\n\n")
    paragraphs, held = [], []
    for line in [*plain.split("\n"), ""]:
        if line.strip():
            held.append(line)
        elif held:
            paragraphs.append("\n".join(held))
            held = []
    sentences = [s for p in paragraphs for s in re.split(r"(?<=[.!?])\s+", p.strip())]
    for name, parts in (("paragraph", paragraphs), ("sentence", sentences), ("word", plain.split())):
        if all(len(p) <= limit for p in parts):
            return name
    return "none"


@settings(max_examples=150, deadline=None)
@given(TEXT, st.integers(5, 60))
def test_division_agrees_with_brute_force(text, limit):
    assert Boundaries(text).division(limit) == brute_division(text, limit)


def test_hard_cut_and_overlap():
    division, spans = split_text("x" * 100, 40, 10)
    assert division == "none" and [s[:2] for s in spans] == [(0, 40), (30, 70), (60, 100)]
    with pytest.raises(ValueError):
        split_text("x", 10, 5)


def test_coarsest_boundary_wins():
    text = "One two. Three four.\n\n" + "Five six seven. " * 4
    assert split_text(text, 40, 5)[1][0][2] == "paragraph"


def test_rows_without_pieces_stay(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "short", "c"), (4, "word " * 50, "d"), (4, "word " * 50, "d"), (None, "y" * 300, None)]
    df = spark.createDataFrame(rows, "id long, body string, piece_no string")
    out = split_oversized(df, "body", 100, 10).collect()
    assert sorted(r["id"] for r in out if r["piece_no"] is None) == [1, 2, 3]
    assert len({(r["id"], r["piece_no"]) for r in out if r["id"] == 4}) == 3 and sum(r["id"] == 4 for r in out) == 6
    assert all(r["piece_text"] == ("y" * 300)[r["piece_start"] : r["piece_end"]] for r in out if r["id"] is None)
    assert split_oversized(df.limit(0), "body", 100, 10).count() == 0
