"""Problem 7: encoding with a byte-pair vocabulary as a tokenization automaton.

The automaton reads tokens, not bytes: a path from its start spells a text in exactly the way the
merges would tokenize it.  It starts as one state with a loop for every byte.  Each merge
``u + v -> w``, in order, changes it by a *gadget*: where ``u`` leads to a state that can go on with
``v``, the ``u`` arcs are redirected to a copy of that state without ``v``, and ``w`` arcs are laid
from where ``u`` began to where ``v`` ended (Berglund, Martens and van der Merwe, *Constructing a BPE
Tokenization DFA*, 2024).

As every arc with the same label leads to the same state, the automaton is a table of one target for
each token, and a state is stored as its difference from the one it was copied from: which token it
lost and in which merge.  ``follows`` reads the arcs off these tables.  A word is encoded by running
the automaton over all its prefixes at once: each prefix has exactly one tokenization, so there is
at most one state at each offset.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The folder of the public tokenizer files; a parameter everywhere.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(name: str, folder: str = TOKENIZERS) -> list[bytes]:
    """The tokens of a rank file by id."""
    with open(f"{folder}/{name}.tiktoken", "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for text, rank in pairs:
        tokens[int(rank)] = base64.b64decode(text)
    return tokens


class Automaton:
    """The tables of the automaton; they can be pickled, and only the token trie is rebuilt."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        count = len(tokens)
        self.target = array("i", [0]) * count  # the state that an arc of the token leads to
        self.left = array("i", [-1]) * count  # the first part of a merged token
        self.made = array("i", [-1]) * count  # the merge that made it; -1 for a byte
        self.parent, self.lost, self.born = array("i", [-1]), array("i", [-1]), array("i", [-1])  # of states; 0 is the start
        self._memory: dict[int, bool] = {}
        self._trie: dict = {}
        for token, text in enumerate(tokens):
            if len(text) == 1:
                self._insert(text, token)
        for merge, (token, text) in enumerate((t, x) for t, x in enumerate(tokens) if len(x) > 1):
            path = self.encode_bytes(text)  # the two parts, as tokenized by the merges so far
            if len(path) != 2:
                raise ValueError(f"token {token} is not made of two earlier tokens")
            self._gadget(merge, path[0], path[1], token)
            self._insert(text, token)

    def _gadget(self, merge: int, u: int, v: int, w: int) -> None:
        state, end = self.target[u], self.target[v]
        self.parent.append(state)
        self.lost.append(v)
        self.born.append(merge)
        self.target[u] = len(self.parent) - 1
        self.target[w], self.left[w], self.made[w] = end, u, merge

    def _insert(self, text: bytes, token: int) -> None:
        node = self._trie
        for byte in text:
            node = node.setdefault(byte, {})
        node[-1] = token

    def follows(self, state: int, token: int) -> bool:
        """Whether the state has an arc of the token."""
        key = state << 20 | token
        known = self._memory.get(key)
        if known is not None:
            return known
        parent, lost, born, left, made = self.parent, self.lost, self.born, self.left, self.made
        answer = True
        while state:
            if made[token] < born[state]:  # the arc was there when the state was copied
                if lost[state] == token:
                    answer = False
                    break
                state = parent[state]
            else:  # the arc was laid wherever its first part had one
                token = left[token]
        self._memory[key] = answer
        return answer

    def encode_bytes(self, text: bytes) -> list[int]:
        """The token ids of one pre-split word."""
        size = len(text)
        states, came = [-1] * (size + 1), [0] * (size + 1)
        states[0] = 0
        trie, target, memory, tokens = self._trie, self.target, self._memory, self.tokens
        for start in range(size):
            state = states[start]
            if state < 0:
                continue
            node, base = trie, state << 20
            for at in range(start, size):
                node = node.get(text[at])
                if node is None:
                    break
                token = node.get(-1)
                if token is not None:
                    answer = memory.get(base | token)
                    if answer is None:
                        answer = self.follows(state, token)
                    if answer:
                        states[at + 1], came[at + 1] = target[token], token
        out, at = [], size
        while at:
            out.append(came[at])
            at -= len(tokens[came[at]])
        out.reverse()
        return out

    def decode(self, ids: list[int]) -> str:
        """The text that a path spells: its arcs' labels one after another."""
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", errors="replace")

    def encoder(self) -> Encoder:
        """The encoder of this process; the words it has met in one task are known in the next."""
        if "_encoder" not in self.__dict__:
            self._encoder = Encoder(self)
        return self._encoder

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_trie", "_memory", "_encoder")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._memory, self._trie = {}, {}
        for token, text in enumerate(self.tokens):
            self._insert(text, token)


class Encoder:
    """Splits texts by the pattern and encodes each distinct word once, as far as memory allows."""

    MOST_WORDS = 300_000

    def __init__(self, automaton: Automaton, pattern: str = PATTERN):
        self.automaton = automaton
        self.split = regex.compile(pattern).findall
        self.words: dict[str, array] = {}

    def encode(self, text: str | None) -> array:
        """Ids of the text; none for an empty and for a null text."""
        out = array("i")
        if not text:
            return out
        words = self.words
        for word in self.split(text):
            ids = words.get(word)
            if ids is None:
                ids = array("i", self.automaton.encode_bytes(word.encode("utf-8")))
                if len(words) >= self.MOST_WORDS:
                    words.clear()
                if len(word) < 64:
                    words[word] = ids
            out.extend(ids)
        return out


def encode_column(df: DataFrame, text: str, automaton: Automaton, out: str = "ids", counts_only: bool = False) -> DataFrame:
    """``df`` without ``text`` and with ``out``: the token ids, or with ``counts_only`` their number.

    The vocabulary is a file of fixed size, so its tables can be broadcast.  Every row comes out;
    null and empty texts give an empty list (number 0).  A column named ``out`` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(automaton)
    kept = [c for c in df.columns if c not in (text, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value.encoder()
        for batch in batches:
            texts = batch.column(len(kept))
            ids = [encoder.encode(t.as_py()) for t in texts]
            if counts_only:
                values = pa.array(np.fromiter((len(i) for i in ids), dtype=np.int64, count=len(ids)))
            else:
                ends = np.cumsum([0, *(len(i) for i in ids)], dtype=np.int32)
                flat = np.concatenate([np.frombuffer(i, dtype=np.int32) for i in ids]) if len(ids) and ends[-1] else np.zeros(0, dtype=np.int32)
                values = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), values], names=[*kept, out])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.select(*kept).schema) if kept else ""
    kind = "bigint" if counts_only else "array<int>"
    schema = f"{fields}, `{out}` {kind}" if fields else f"`{out}` {kind}"
    return df.select(*kept, F.col(text)).mapInArrow(run, schema)


def decode_column(df: DataFrame, ids: str, automaton: Automaton, out: str = "text") -> DataFrame:
    """``df`` with ``out``: the text that the ids spell; null ids give null."""
    shared = df.sparkSession.sparkContext.broadcast(automaton)

    @F.pandas_udf("string")
    def spell(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lists in series:
            yield pd.Series([None if x is None else shared.value.decode(x) for x in lists], dtype=object)

    return df.withColumn(out, spell(F.col(ids)))
