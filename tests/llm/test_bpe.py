import pickle

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiloom.llm import bpe
from lexiloom.llm.queries import automaton

SMALL = [bytes([i]) for i in range(256)] + [b"aa", b"ab", b"aab", b"ba", b"aaaa", b"bab", b"abab"]


def by_merging(tokens, text):
    """The tokenization by repeated merging of the earliest pair."""
    ranks = {t: i for i, t in enumerate(tokens)}
    parts = [text[i : i + 1] for i in range(len(text))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abc", max_size=14))
def test_small_automaton_agrees_with_merging(text):
    made = test_small_automaton_agrees_with_merging.__dict__.setdefault("made", bpe.Automaton(SMALL))
    assert made.encode_bytes(text.encode()) == by_merging(SMALL, text.encode())


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_whole_vocabulary_agrees_with_the_library(text):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(f"{bpe.TOKENIZERS}/byte_bpe_50k.json")
    tokenizer.encode_special_tokens = True
    ids = list(automaton().encoder().encode(text))
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids
    assert automaton().decode(ids) == text


def test_tables_survive_pickling():
    again = pickle.loads(pickle.dumps(automaton()))
    assert list(again.encoder().encode("of the abbey, 1497")) == list(automaton().encoder().encode("of the abbey, 1497"))


def test_rows_without_text(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "a b" * 3000, None), (3, "a b" * 3000, None), (None, " ", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.encode_column(df, "text", automaton())
    got = [(r["doc_id"], len(r["ids"])) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(1, 0), (2, 0), (3, 3001), (3, 3001), (None, 1)], key=str)
    assert bpe.encode_column(df.limit(0), "text", automaton()).count() == 0
    counted = bpe.encode_column(df, "text", automaton(), "n", counts_only=True).collect()
    assert sorted(r["n"] for r in counted) == [0, 0, 1, 3001, 3001] and counted[0]["ids"] is not None
    spelled = bpe.decode_column(out.where("doc_id = 3").limit(1), "ids", automaton()).first()
    assert spelled["text"] == "a b" * 3000
