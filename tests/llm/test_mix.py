import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiloom.llm import mix
from lexiloom.llm.queries import automaton


def test_goals_fill_up_what_others_cannot_give():
    goal = mix.goals({"a": 100, "b": 10, "c": 90}, {"a": 0.3, "b": 0.4, "c": 0.3}, {"a": 5, "b": 2, "c": 5})
    assert goal["b"] == 20 and math.isclose(goal["a"], 90) and math.isclose(sum(goal.values()), 200)
    assert sum(mix.goals({"a": 10, "b": 10}, {"a": 1.0, "b": 0.0}, {"a": 1, "b": 9}).values()) == 10
    assert mix.goals({}, {}, {}) == {}


def inverted(chance, rate):
    count, term, total = 0, math.exp(-rate), math.exp(-rate)
    while total <= 1 - chance:
        count += 1
        term *= rate / count
        total += term
    return count


@settings(max_examples=200, deadline=None)
@given(st.floats(0.001, 0.999), st.floats(0.01, 12))
def test_repetitions_are_the_inverted_distribution(chance, rate):
    edge = np.abs(mix.chances(rate, 60) - chance).min()
    if edge > 1e-12:
        assert mix.repetitions(rate, 60, np.array([chance]))[0] == inverted(chance, rate)
        assert mix.repetitions(rate, 2, np.array([chance]))[0] == min(2, inverted(chance, rate))


def test_great_rates_do_not_underflow():
    counts = mix.repetitions(1000.0, 5000, np.array([0.999, 0.5, 0.001]))
    assert 890 < counts[0] < 910 and abs(counts[1] - 1000) <= 1 and 1090 < counts[2] < 1110
    assert mix.repetitions(0.0, 5, np.array([0.5]))[0] == 0 and len(mix.chances(1.0, 0)) == 0


def test_shares_are_met_and_caps_kept(spark):
    docs = [(i, "word " * (5 + i % 7), "big" if i % 3 else "small") for i in range(600)] + [(900, None, "big"), (901, "", "small"), (902, "x", None), (903, "y", "unlisted")]
    targets = [("big", 0.5, 1), ("small", 0.4, 2), ("small", 0.4, 2), ("absent", 0.1, 3), ("tiny", None, None), (None, 0.5, 1)]
    documents = spark.createDataFrame(docs, "doc_id long, text string, source string")
    wanted = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    chosen, shares = mix.mixture(documents, wanted, automaton())
    rows = chosen.collect()
    sizes = {s[0]: s[3] for s in shares}
    total = sum(sizes.values())
    got = {s: sum(r["n_tokens"] * r["copies"] for r in rows if r["source"] == s) for s in sizes}
    # the absent source's share goes to the others in proportion
    assert abs(got["big"] - total * 5 / 9) < 15 and abs(got["small"] - total * 4 / 9) < 15 and got["absent"] == got["tiny"] == 0
    assert len({r["doc_id"] for r in rows}) == len(rows) and all(1 <= r["copies"] <= (1 if r["source"] == "big" else 2) for r in rows)
    again = mix.shuffled(mix.mixture(documents, wanted, automaton(), with_text=True)[0]).collect()
    assert sorted((r["doc_id"], r["copy_no"]) for r in again) == sorted((r["doc_id"], k) for r in rows for k in range(1, r["copies"] + 1))
    assert [r["shuffle_key"] for r in again] == sorted(r["shuffle_key"] for r in again) and all(r["text"] for r in again)
    empty, _ = mix.mixture(documents.limit(0), wanted, automaton())
    assert empty.count() == 0


def test_a_small_source_may_be_repeated_very_often(spark):
    docs = [(0, "rare words", "tiny")] + [(i, "word " * 20, "big") for i in range(1, 400)]
    documents = spark.createDataFrame(docs, "doc_id long, text string, source string")
    wanted = spark.createDataFrame([("tiny", 0.5, 2000), ("big", 0.5, 1)], "source string, target_share double, max_repeats int")
    chosen, shares = mix.mixture(documents, wanted, automaton())
    tiny = next(r for r in chosen.collect() if r["doc_id"] == 0)
    goal = next(s[4] for s in shares if s[0] == "tiny")
    assert tiny["copies"] > 745 and abs(tiny["copies"] * tiny["n_tokens"] - goal) <= tiny["n_tokens"]
