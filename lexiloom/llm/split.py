"""Problem 1: splitting oversized texts at natural boundaries.

A text is read as tokens (runs of characters that are not white space).  Prefix sums of the token
lengths give the offset of every token end; those offsets are the sorted boundary array of the
level *word*, and the ones among them that end a sentence or a paragraph make the coarser arrays.  A
piece starts at ``start``; the last boundary that is not beyond ``start + limit`` is found by binary
search, first among paragraphs, then sentences, then words; where there is none the text is cut hard
at the limit.  The next piece starts ``overlap`` before the cut, at a word's start where one is near.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A paragraph mark is as long as the white space that takes its place while offsets are computed.
PARAGRAPH_MARK, MARK_SPACE = "«P»", "\n\n\n"
TOKEN = regex.compile(r"\S+")
DIVISIONS = ("paragraph", "sentence", "word", "none")


class Boundaries:
    """The sorted boundary arrays of one text, and the spans of its paragraphs and words."""

    def __init__(self, text: str):
        plain = text.replace(PARAGRAPH_MARK, MARK_SPACE)
        spans = np.array([m.span() for m in TOKEN.finditer(plain)], dtype=np.int64).reshape(-1, 2)
        # lengths of tokens with the space before them; their prefix sums are the offsets of the token ends
        before = np.concatenate(([0], spans[:-1, 1])) if len(spans) else np.zeros(0, dtype=np.int64)
        self.words = np.cumsum(spans[:, 1] - before)
        self.starts = spans[:, 0]
        self.paragraphs = self._paragraphs(plain)
        ends = np.array([e for _, e in self.paragraphs], dtype=np.int64)
        stops = np.array([plain[e - 1] in ".!?" for e in self.words], dtype=bool) if len(self.words) else np.zeros(0, dtype=bool)
        # a paragraph may end in white space; its last word is then the boundary
        last = np.searchsorted(self.words, ends, side="right") - 1
        self.paragraph_ends = np.unique(self.words[last[last >= 0]]) if len(ends) else ends
        self.sentence_ends = np.union1d(self.words[stops], self.paragraph_ends)

    @staticmethod
    def _paragraphs(plain: str) -> list[tuple[int, int]]:
        """Spans of the runs of lines that are not blank."""
        spans: list[tuple[int, int]] = []
        at, start, end = 0, -1, -1
        for line in plain.split("\n"):
            if line.strip():
                start, end = (at if start < 0 else start), at + len(line)
            elif start >= 0:
                spans.append((start, end))
                start = -1
            at += len(line) + 1
        if start >= 0:
            spans.append((start, end))
        return spans

    def division(self, limit: int) -> str:
        """The coarsest division whose parts all fit into ``limit``."""
        if all(e - s <= limit for s, e in self.paragraphs):
            return "paragraph"
        begins = self.starts[np.concatenate(([0], np.searchsorted(self.starts, self.sentence_ends[:-1])))] if len(self.sentence_ends) else self.starts[:0]
        if np.all(self.sentence_ends - begins <= limit):
            return "sentence"
        return "word" if np.all(self.words - self.starts <= limit) else "none"

    def pieces(self, text: str, limit: int, overlap: int) -> list[tuple[int, int, str]]:
        """Spans ``(start, end, cut)`` of at most ``limit``, each beginning about ``overlap`` before the last end."""
        out: list[tuple[int, int, str]] = []
        start, size = 0, len(text)
        levels = (("paragraph", self.paragraph_ends), ("sentence", self.sentence_ends), ("word", self.words))
        while size - start > limit:
            end, cut = start + limit, "none"
            for name, array in levels:
                # a coarse boundary may leave at most half of the piece unused
                least = start + (overlap + 1 if name == "word" else max(overlap + 1, limit // 2))
                at = bisect_right(array, start + limit) - 1
                if at >= 0 and array[at] >= least:
                    end, cut = int(array[at]), name
                    break
            out.append((start, end, cut))
            if not text[end:].strip():
                return out
            start = self._restart(start, end, overlap)
        out.append((start, size, "end"))
        return out

    def _restart(self, start: int, end: int, overlap: int) -> int:
        back = max(start + 1, end - overlap)
        at = bisect_left(self.starts, back)
        near = int(self.starts[at]) if at < len(self.starts) else end
        return near if near < end and near - back <= overlap // 2 else back


def split_text(text: str, limit: int = 6000, overlap: int = 200) -> tuple[str, list[tuple[int, int, str]]]:
    """The division and the piece spans of one text; a text within the limit is one piece.

    Offsets count code points.  White space after the last piece is dropped; an empty text is one
    empty piece.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half of the limit")
    if len(text) <= limit:
        return "paragraph", [(0, len(text), "end")]
    found = Boundaries(text)
    return found.division(limit), found.pieces(text, limit, overlap)


def split_oversized(df: DataFrame, text: str, limit: int = 6000, overlap: int = 200, with_text: bool = True) -> DataFrame:
    """A row for each piece of the texts longer than ``limit``, after the other columns of ``df``.

    Adds ``piece_no`` (from 1), ``piece_start`` and ``piece_end`` (code points, end exclusive),
    ``piece_cut`` (what the piece ends at), ``piece_division`` (the text's coarsest division that
    fits) and, if asked for, ``piece_text``.  Columns of these names in ``df`` are replaced.  A null
    text, an empty one and any within the limit give one row with null pieces, so that no row of
    ``df`` is lost; equal rows are split alike.  The text itself does not come out.  The map is
    narrow: nothing is shuffled and a text is only held by the task that splits it.
    """
    added = T.StructType(
        [
            T.StructField("piece_no", T.IntegerType()),
            T.StructField("piece_start", T.IntegerType()),
            T.StructField("piece_end", T.IntegerType()),
            T.StructField("piece_cut", T.StringType()),
            T.StructField("piece_division", T.StringType()),
        ]
        + ([T.StructField("piece_text", T.StringType())] if with_text else [])
    )
    names = [f.name for f in added]

    @F.pandas_udf(T.ArrayType(added))
    def pieces(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            out = []
            for value in series:
                if value is None:
                    out.append(None)
                    continue
                division, spans = split_text(value, limit, overlap)
                rows = [(n, s, e, cut, division) + ((value[s:e],) if with_text else ()) for n, (s, e, cut) in enumerate(spans, 1)]
                out.append([dict(zip(names, row)) for row in rows])
            yield pd.Series(out, dtype=object)

    kept = [c for c in df.columns if c != text and c not in names]
    long = F.when(F.length(text) > limit, F.col(text))
    return df.select(*kept, pieces(long).alias("__pieces")).select(*kept, F.explode_outer("__pieces").alias("__piece")).select(*kept, "__piece.*")
