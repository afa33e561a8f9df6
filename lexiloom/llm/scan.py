"""Problem 5: repairing text from scanned pages.

*Furniture.*  Lines at the edges of a page are compared by shape and, with their digits masked, over
all pages: a line that looks like a stamp or a running head is one if its mask is met at edges rather
than in the text.

*Words.*  All words of the text are counted and grouped by their skeleton, in which glyphs that scans
confuse are the same strokes.  A rarer form in the group of a more frequent one that single confusions
lead to is a misreading of it if its contexts, the words before and after it, do not speak against
that: they must be contexts of the frequent form about as often as that form's own are.  The less often
the rare form stands, the less its few contexts can say, and the more the counts decide.

*Cut words.*  A line that ends in a hyphen is cut unless the two parts are a word that is printed
with a hyphen elsewhere.

Counting and joining are distributed; what is broadcast is the most frequent words (a fixed number,
and only to save work) and bits of a fixed number for the contested ones.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.names import fold, skeleton
from lexiloom.operators.ordered import last_known, next_known
from lexiloom.session import cut_lineage

#: Signs that a printed or scanned line may end in where a word is cut.
HYPHENS = "-‐‑¬=\xad"
_CUT = re.compile(rf"([^\W\d_]|[\dſﬁﬂ@])([{HYPHENS}])(\s*)$")
#: How a scan may have read the number of a page.
_NUMBER = r"(?:\d{1,4}|[ivxlc]{1,8}|[IVXLC]{1,8}|(?=[\dlIOSoB]*\d)[\dlIOSoBs]{1,4}|[lIO]{1,2})"
_PAGE = re.compile(rf"^[\s\[(*·.~—–\-]*(?:(?:p|page|leaf|fol|sheet)\.?\s*)?{_NUMBER}[\s\])*·.~—–\-]*$")
_YEAR = re.compile(r"^1\d{3}[.,;:)]*$")
_SHEET = re.compile(r"^(?:[A-Z]{1,2} ?\d{1,2}|VOL\.? [IVXLC]+\.? ?\d{0,3})$")
_MARKUP = re.compile(r"^(?:</?noinclude>|\{\{[^{}]*\}\}|\s)+$")
#: Words of stamps.
_STAMP = re.compile(r"\b(?:scan(?:ned|s)?|digiti[sz]ed|image of|leaf|shelf|library|lib\.|reading room|archives?|microfilm(?:ed)?|facsimile)\b", re.I)
_STOP = re.compile(r"[.,;:?!)\"”’]\s*$|[" + HYPHENS + r"]\s*$")
_WORD = re.compile(r"[^\s—–]+")
_EDGE = ".,;:()[]?!\"“”„«»‘’'*†·…"
_IRREGULAR = re.compile(r"[ſﬁﬂﬀﬃﬄ@]")
_MIXED = re.compile(r"^(?=.*\d)(?=.*[^\W\d_])[\w,.]+$")
_ORDINAL = re.compile(r"^\d+(?:st|nd|rd|th|s|d|m|ft|in|lb)?$", re.I)
_GAP = re.compile(r"\s{3}")
_FIGURES = re.compile(r"^(?=.*[lOS])[lOSI]{2,4}$")
#: The most frequent words, which are not looked up one by one.
FREQUENT = 20_000


def _running_head(line: str) -> str | None:
    """``sure`` or ``caps`` if the line looks like a running head, with or without a page number."""
    words = [w for w in re.split(r"[\s—–]+", line.strip()) if w]
    numbered = False
    for end in (0, -1):
        if len(words) < 2:
            break
        number = words[end].strip("[]()")
        year, capitals = number.isdigit() and len(number) > 3, number.isupper() and not any(c.isdigit() for c in number) and number != "O"
        if re.fullmatch(_NUMBER, number) and not year and not capitals:
            numbered = True
            words.pop(end)
    text = " ".join(words)
    letters = [c for c in text if c.isalpha()]
    if len(letters) < 3 or len(words) > 12 or re.search(r"\d", text) or text.endswith((".", ",", ";", ":")):
        return None
    upper = sum(c.isupper() for c in letters) / len(letters)
    if upper >= 0.85:
        return "sure" if numbered or "[" in text or "]" in text else "caps"
    titled = all(w[:1].isupper() or w.lower() in ("of", "the", "and", "de", "to") or not w[:1].isalpha() for w in words)
    return "sure" if numbered and titled and len(words) <= 6 else None


def mask(line: str) -> str:
    """The line with its figures and page numerals masked and its spaces made one."""
    return re.sub(r"\s+", " ", re.sub(r"\b[ivxlc]+\b", "#", re.sub(r"\d+", "#", line.strip())))


class Page:
    """The lines of one text of a page, sorted into furniture, what may be furniture, and text."""

    def __init__(self, text: str):
        self.lines = text.split("\n")
        full = [i for i, line in enumerate(self.lines) if line.strip()]
        widths = sorted(len(self.lines[i].rstrip()) for i in full)
        self.width = widths[len(widths) // 2] if widths else 0
        self.sure: set[int] = set()
        self.maybe: dict[int, tuple[str, bool]] = {}  # line: its mask, and whether it is furniture unless known better
        self.edge: set[int] = set()  # of those, the ones at the page's edges
        for order, top in ((full, True), (full[::-1], False)):
            for at, i in enumerate(order):
                kind = self._kind(i, top, at)
                if kind == "sure":
                    self.sure.add(i)
                elif kind in ("caps", "stamp"):
                    self.maybe[i] = (mask(self.lines[i]), kind == "caps")
                    self.edge.add(i)
                else:
                    break
        for i in full:  # a running head may have slipped into the text
            line = self.lines[i].strip()
            if i in self.sure or i in self.maybe or len(line) > 70:
                continue
            # two numerals hold sixteen letters at most: such a line is neither in capitals nor a head in the text
            if sum(map(str.islower, line)) > sum(map(str.isupper, line)) + 16 and not _GAP.search(line):
                continue
            head = _running_head(line)
            if head and (not any(c.islower() for c in re.sub(rf"\b{_NUMBER}\b", "", line)) or re.search(r"\s{3}", line)) and (head == "sure" or re.search(r"[A-Z)](?:—| TO )[A-Z]", line)):
                self.sure.add(i)
            elif head == "caps":
                self.maybe[i] = (mask(line), False)
        self.text = [i for i in full if i not in self.sure and not (i in self.maybe and self.maybe[i][1])]

    def _kind(self, i: int, top: bool, at: int) -> str | None:
        line = self.lines[i].strip()
        if _MARKUP.match(line) or not re.search(r"\w", line):
            return "sure"
        if _YEAR.match(line):
            return None
        if _SHEET.match(line) or _PAGE.match(line):
            # the last figures of a sentence are no page number
            figures = line[0].isdigit() and line.endswith(".") and not self.lines[i][:1].isspace()
            return None if figures else "sure"
        short = len(line) <= 0.8 * max(self.width, 30)
        if short and not _STOP.search(line.rstrip(")]")) and _STAMP.search(line) and (line[0].isupper() or line[0] == "["):
            return "sure"
        if re.fullmatch(r"\[[^\]]*\d+\]", line):
            return "sure"
        if top:
            head = _running_head(line)
            if head and (head == "sure" or len(line) <= 70):
                return head
        if short and len(line) >= 4 and not _STOP.search(line) and (line[0].isupper() or not line[0].isalnum()) and len(line) <= 0.7 * self.width:
            return "stamp"
        return None

    def cut(self, i: int) -> tuple[str, str, bool] | None:
        """``(first part, sign, space after it)`` if the line ends in a cut word."""
        m = _CUT.search(self.lines[i])
        if not m:
            return None
        return clean(_WORD.findall(self.lines[i])[-1].rstrip()[:-1]), m.group(2), bool(m.group(3))

    def first_word(self, i: int) -> str:
        found = _WORD.search(self.lines[i])
        return clean(found.group()) if found else ""


def clean(word: str) -> str:
    return word.strip(_EDGE)


def odd(word: str) -> bool:
    """Whether the word shows by itself that a character was misread."""
    if _IRREGULAR.search(word) or _FIGURES.match(word):
        return True
    return any(_MIXED.match(part) and not _ORDINAL.match(part) for part in re.split(r"[-/]", word.replace("'", "").replace("’", "")) if part)


def parts(word: str) -> list[str]:
    """The folded words of a token that dictionaries know: the parts of a compound, without possessives."""
    return [p for p in re.split(r"[-‐‑/]", fold(re.sub(r"['’]s?$", "", word))) if len(p) > 1 and p.isalpha()]


@lru_cache(maxsize=300_000)
def looked_at(token: str) -> tuple[str, tuple[str, ...], str | None, bool]:
    """A token as it is cleaned, its words, the compound it may be, and whether it is odd without its hyphen."""
    word = clean(token)
    return word, tuple(parts(word)), fold(word) if "-" in word else None, odd(word.rstrip(HYPHENS))


#: Single confusions, each way.
_CONFUSIONS = [("c", "e"), ("t", "f"), ("li", "h"), ("a", "@"), ("i", "r"), ("s", "ſ"), ("u", "n"), ("0", "o"), ("cl", "d"), ("i", "l"), ("l", "1"), ("rn", "m"), ("ii", "u"), ("vv", "w"), ("6", "b"), ("in", "m"), ("9", "g"), ("ri", "n"), ("ni", "m"), ("l", "r")]
_STEPS = [*_CONFUSIONS, *[(b, a) for a, b in _CONFUSIONS]]


@lru_cache(maxsize=200_000)
def confusions(wrong: str, right: str, most: int = 3) -> int:
    """Confusions that lead from one word to the other, or ``most + 1`` if more."""
    rows: dict[tuple[int, int], int] = {(0, 0): 0}
    stack = [(0, 0)]
    best = most + 1
    while stack:
        at = i, j = stack.pop()
        cost = rows[at]
        if i == len(wrong) and j == len(right):
            best = min(best, cost)
            continue
        moves = [(i + 1, j + 1, cost)] if i < len(wrong) and j < len(right) and wrong[i] == right[j] else []
        if cost < most:
            moves += [(i + len(a), j + len(b), cost + 1) for a, b in _STEPS if wrong.startswith(a, i) and right.startswith(b, j)]
        for x, y, c in moves:
            if rows.get((x, y), most + 1) > c:
                rows[(x, y)] = c
                stack.append((x, y))
    return best


def may_misread(wrong: str, n_wrong: int, right: str, n_right: int) -> bool:
    """Whether the counts and the confusions allow the first form to be a misreading of the second.

    Counts matter by their ratio alone, so that the same noise is judged alike in a corpus of any size.
    """
    rare = (n_right >= 2 * n_wrong + 1 and len(right) > 3) or n_right >= 60 * n_wrong
    return len(right) > 1 and rare and confusions(wrong, right) <= (2 if len(right) < 7 else 3)


#: The same for SQL, without the confusions.
_RARE = "length(right) > 1 AND ((n_right >= 2 * n + 1 AND length(right) > 3) OR n_right >= 60 * n)"


def supported(shared: int, seen: int, own: float) -> bool:
    """Whether contexts allow a misreading: ``shared`` of the ``seen`` contexts of the rare form are met with the
    other one too, of whose own contexts the share ``own`` is met more than once.

    Half of that share is asked for, less the error that so few contexts have.
    """
    return seen == 0 or shared / seen >= own / 2 - 1 / seen**0.5


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of words, compounds and masks of each batch of pages."""
    for f in frames:
        words: dict[str, Counter] = {k: Counter() for k in ("word", "compound", "edge", "text")}
        for text in f["text"]:
            if not text:
                continue
            page = Page(text)
            for i, (m, _) in page.maybe.items():
                words["edge" if i in page.edge else "text"][m] += 1
            plain: list[str] = []
            held = ""
            for i in page.text:
                if i in page.maybe:
                    continue
                line = page.lines[i]
                # no line of an edge that may be furniture is longer, or begins with a small letter that is no numeral
                if len(line) <= max(70, 0.7 * page.width) and (not (first := line.lstrip()[0]).islower() or first in "ivxlc"):
                    words["text"][mask(line)] += 1
                tokens = _WORD.findall(line)
                cut = page.cut(i)
                if held and tokens:
                    tokens[0] = held + clean(tokens[0]) if held != "?" else ""
                held = ""
                if cut:
                    # a plain hyphen may belong to the word; such a word is not counted
                    held = "?" if cut[1] == "-" and not cut[2] else cut[0]
                    tokens = tokens[:-1]
                for token in tokens:
                    _, inside, compound, _ = looked_at(token)
                    plain += inside
                    if compound:
                        words["compound"][compound] += 1
            words["word"].update(plain)
        yield pd.DataFrame([(k, w, n) for k, counted in words.items() for w, n in counted.items()], columns=["kind", "word", "n"])


def counts(pages: DataFrame) -> DataFrame:
    """Columns ``kind, word, n`` over the texts of ``pages(page_id, volume, page_number, field_name, text)``."""
    counted = pages.select("text").mapInPandas(_count, "kind string, word string, n long")
    return cut_lineage(counted.groupBy("kind", "word").agg(F.sum("n").alias("n")))


def candidates(counted: DataFrame) -> DataFrame:
    """Columns ``word, n, right, n_right``: word forms with those of their skeleton that they may be misreadings of."""
    stroked = F.pandas_udf(lambda s: s.map(skeleton), "string")
    words = counted.where(F.col("kind") == "word").select("word", "n", stroked(F.col("word")).alias("strokes"))
    # every form of the group may be the right one; the counts that may_misread() asks for are part of the join
    best = words.select("strokes", F.col("word").alias("right"), F.col("n").alias("n_right"))
    near = words.join(best, "strokes").where(F.expr(_RARE) & (F.col("word") != F.col("right")))

    @F.pandas_udf("boolean")
    def judged(wrong: pd.Series, n: pd.Series, right: pd.Series, n_right: pd.Series) -> pd.Series:
        return pd.Series([may_misread(*row) for row in zip(wrong, n, right, n_right)], dtype=bool)

    return cut_lineage(near.where(judged("word", "n", "right", "n_right")).select("word", "n", "right", "n_right"))


def misread_forms(maybe: DataFrame, contexts: DataFrame) -> DataFrame:
    """Columns ``word, right``: the candidates whose contexts do not speak against them, with what they stand for.

    ``contexts`` has ``side, word, other, n``: how often ``other`` stands before or after the word.
    """
    own = contexts.join(maybe.select(F.col("right").alias("word")).distinct(), "word").groupBy(F.col("word").alias("right")).agg((F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)) / F.sum("n")).alias("own"))
    theirs = contexts.select("side", F.col("word").alias("right"), "other", F.lit(1).alias("hit"))
    met = maybe.select("word", "right").join(contexts, "word").join(theirs, ["side", "right", "other"], "left")
    seen = met.groupBy("word", "right").agg(F.sum("n").alias("seen"), F.sum(F.col("n") * F.coalesce("hit", F.lit(0))).alias("shared"))
    judged = maybe.join(seen, ["word", "right"], "left").join(own, "right", "left")

    @F.pandas_udf("boolean")
    def fits(shared: pd.Series, seen: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series([supported(*row) for row in zip(shared, seen, own)], dtype=bool)

    zero = F.lit(0)
    kept = judged.where(fits(F.coalesce("shared", zero), F.coalesce("seen", zero), F.coalesce("own", F.lit(0.0))))
    return cut_lineage(kept.groupBy("word").agg(F.max_by("right", F.struct("n_right", "right")).alias("right")))


def contested_forms(counted: DataFrame, maybe: DataFrame) -> DataFrame:
    """Columns ``word, other``: words that one confusion turns into each other, where the counts could not tell."""
    words = counted.where(F.col("kind") == "word").select("word", "n").join(maybe.select("word"), "word", "left_anti")
    stroked = F.pandas_udf(lambda s: s.map(skeleton), "string")
    top = words.select("word", stroked(F.col("word")).alias("strokes"))
    one = F.pandas_udf(lambda a, b: pd.Series([len(x) > 1 and len(y) > 1 and confusions(x, y, 1) == 1 for x, y in zip(a, b)], dtype=bool), "boolean")
    pairs = top.join(top.withColumnRenamed("word", "other"), "strokes").where(F.col("word") != F.col("other"))
    return cut_lineage(pairs.where(one("word", "other")).select("word", "other"))


def out_of_context(notes: DataFrame, contested: DataFrame, contexts: DataFrame) -> DataFrame:
    """Lines where the words to both sides support the other form: the counts of
    (word before, form) and (form, word after) come to twenty times those of the form that was read."""
    sides = F.split("key2", "\x1f")
    at = notes.where(F.col("note") == "B").select("page_id", "field_name", "line_no", F.col("key").alias("word"), sides[0].alias("before"), sides[1].alias("after"))
    left = contexts.where("side = '<'").select(F.col("other").alias("before"), "word", "n")
    right = contexts.where("side = '>'").select(F.col("other").alias("after"), "word", "n")
    asked = at.where("before <> '' AND after <> ''").join(contested, "word")
    for form in ("word", "other"):
        asked = asked.join(left.select("before", F.col("word").alias(form), F.col("n").alias(f"left_{form}")), ["before", form], "left")
        asked = asked.join(right.select("after", F.col("word").alias(form), F.col("n").alias(f"right_{form}")), ["after", form], "left")
    own, rival = F.col("left_word") + F.col("right_word"), F.col("left_other") + F.col("right_other")
    return asked.where(rival >= 20 * own).select("page_id", "field_name", "line_no").distinct()


_NOTES = "page_id long, volume int, page_number int, field_name string, line_no int, note string, key string, key2 string, second int, cut int"


#: Bits for the words whose contexts are asked for.
_BITS = 1 << 24


def _bit(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % _BITS


def _marked(words: DataFrame, column: str) -> bytes:
    """The words as bits of a fixed number; one that falls on the bit of another is left when notes meet the words."""
    bits = bytearray(_BITS // 8)
    for r in words.select(F.col(column).alias("w")).distinct().toLocalIterator():
        at = _bit(r["w"])
        bits[at >> 3] |= 1 << (at & 7)
    return bytes(bits) if any(bits) else b""


def annotate(pages: DataFrame, counted: DataFrame, maybe: DataFrame, contested: DataFrame) -> DataFrame:
    """What each page shows by itself and what has to be looked up, as notes on its lines.

    Notes: ``F`` furniture; ``U`` furniture or text by its mask (``cut`` 1: furniture unless known
    better); ``H`` cut; ``C`` cut unless the compound ``key`` exists; ``M`` misread; ``W`` misread if the
    word ``key`` is (it goes on in line ``second`` after ``cut`` characters); ``O`` a cut at the page's
    end with the first part ``key`` (``cut`` 1: by a plain hyphen); ``P`` the page's first word; ``B`` a
    contested word with its neighbours in the line.  Notes ``<`` and ``>`` are of no page: ``key2`` stands
    ``second`` times before or after the word ``key``.
    """
    spark = pages.sparkSession
    usual = counted.where(F.col("kind") == "word").select("word", "n").join(maybe.select("word").distinct(), "word", "left_anti")
    frequent = spark.sparkContext.broadcast({r["word"] for r in usual.orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").collect()})
    unsure = spark.sparkContext.broadcast((_marked(contested, "word"), _marked(maybe.select("word").unionByName(maybe.select(F.col("right").alias("word"))).unionByName(contested.select("word")), "word")))

    def note(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = frequent.value
        between, paired = unsure.value
        columns = [c.split()[0] for c in _NOTES.split(", ")]

        @lru_cache(maxsize=300_000)
        def asked(token: str) -> tuple[str, bool, tuple[str, ...], bool, bool]:
            """The folded token, whether it is odd, its words that are to be looked up, and whether it is contested or paired."""
            word, inside, _, strange = looked_at(token)
            word = fold(word)
            at = _bit(word)
            marks = [bool(b and b[at >> 3] >> (at & 7) & 1) for b in (between, paired)]
            return word, strange, tuple(p for p in inside if p not in known), *marks

        def frame(out: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(out, columns=columns).astype({"page_id": "Int64", "volume": "Int32", "page_number": "Int32", "line_no": "Int32", "second": "Int32", "cut": "Int32"})

        for f in frames:
            out = []
            beside: Counter = Counter()
            for page_id, volume, number, field, text in zip(f["page_id"], f["volume"], f["page_number"], f["field_name"], f["text"]):
                if not text:
                    continue
                head, page = (page_id, volume, number, field), Page(text)
                out += [(*head, i + 1, "F", None, None, None, None) for i in sorted(page.sure)]
                out += [(*head, i + 1, "U", m, None, None, int(default)) for i, (m, default) in sorted(page.maybe.items())]
                lines, held = page.text, None
                for k, i in enumerate(lines):
                    line, under = page.lines[i], page.maybe[i][0] if i in page.maybe else None
                    raw = _WORD.findall(line)
                    tokens = [asked(t) for t in raw]
                    if any(t[1] for t in tokens):
                        out.append((*head, i + 1, "M", None, under, None, None))
                    for j, (w, _, _, is_contested, is_paired) in enumerate(tokens):
                        if is_paired:
                            before, after = tokens[j - 1][0] if j else "", tokens[j + 1][0] if j + 1 < len(tokens) else ""
                            if before:
                                beside["<", w, before] += 1
                            if after:
                                beside[">", w, after] += 1
                            if is_contested:
                                out.append((*head, i + 1, "B", w, f"{before}\x1f{after}", None, None))
                    if k == 0:
                        out.append((*head, i + 1, "P", clean(raw[0]) if raw else "", None, None, None))
                    cut = page.cut(i)
                    if held is not None and tokens:
                        joined = fold(held[1] + clean(raw[0]))
                        if joined.isalpha() and joined not in known:
                            out.append((*head, held[0] + 1, "W", joined, None, i + 1, len(fold(held[1]))))
                        tokens = tokens[1:]
                    held = None
                    if cut:
                        left, sign, space = cut
                        plain = sign == "-" and not space
                        tokens = tokens[:-1]
                        if k + 1 < len(lines):
                            held = (i, left)
                            right = page.first_word(lines[k + 1])
                            out.append((*head, i + 1, "C" if plain else "H", fold(f"{left}-{right}") if plain else None, under, None, None))
                        else:
                            out.append((*head, i + 1, "O", fold(left), under, None, int(plain)))
                    out += [(*head, i + 1, "W", part, under, None, None) for t in tokens for part in t[2]]
            out += [(None, None, None, None, None, side, w, other, n, None) for (side, w, other), n in beside.items()]
            yield frame(out)

    return cut_lineage(pages.select("page_id", "volume", "page_number", "field_name", "text").mapInPandas(note, _NOTES))


def first_difference(wrong: str, right: str) -> int:
    """Characters at the beginning that both words share."""
    same = 0
    for a, b in zip(wrong, right):
        if a != b:
            break
        same += 1
    return same


def noise(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(found, wrong, notes)``: the noisy lines, the misread forms, and the notes they come from.

    ``pages`` has ``page_id, volume, page_number, field_name, text``; null, empty and blank texts have
    no lines to report.  ``found`` has ``page_id, field_name, line_no, kind``; a page's copies count
    once, and a line can be of two kinds.
    """
    counted = counts(pages)
    maybe = candidates(counted)
    contested = contested_forms(counted, maybe)
    notes = annotate(pages, counted, maybe, contested)
    contexts = notes.where(F.col("note").isin("<", ">")).groupBy(F.col("note").alias("side"), F.col("key").alias("word"), F.col("key2").alias("other")).agg(F.sum("second").alias("n"))
    contexts = cut_lineage(contexts)
    wrong = misread_forms(maybe, contexts)
    masks = counted.where(F.col("kind").isin("edge", "text")).groupBy(F.col("word").alias("key")).agg(
        F.sum(F.when(F.col("kind") == "edge", F.col("n")).otherwise(0)).alias("edges"), F.sum(F.when(F.col("kind") == "text", F.col("n")).otherwise(0)).alias("texts")
    ).where(F.col("edges") > 0)
    # what may be a head is one unless it is met in the text; what may be a stamp must be met often, at edges only
    decided = masks.select("key", F.when(F.col("texts") * 3 > F.col("edges"), F.lit(-1)).when((F.col("edges") >= 3) & (F.col("texts") * 6 <= F.col("edges")), F.lit(1)).otherwise(0).alias("verdict"))
    unsure = notes.where(F.col("note") == "U").join(decided, "key", "left").select("page_id", "field_name", "line_no", "key", ((F.coalesce("verdict", F.lit(0)) + F.col("cut")) >= 1).alias("furniture"))
    unsure = cut_lineage(unsure)
    line = ["page_id", "field_name", "line_no"]
    furniture = notes.where(F.col("note") == "F").select(*line).unionByName(unsure.where("furniture").select(*line))

    compounds = counted.where((F.col("kind") == "compound") & (F.col("n") >= 2)).select(F.col("word").alias("key"), F.lit(True).alias("printed"))
    ends = notes.where(F.col("note").isin("O", "P")).groupBy("volume", "field_name", "page_number", "page_id").agg(
        F.max(F.when(F.col("note") == "P", F.col("key"))).alias("first"), F.max(F.when(F.col("note") == "O", F.struct("line_no", "key", "cut"))).alias("open")
    )
    # the word goes on in the next page that has text, in the other field if this one is not there
    word = {f: F.max(F.when(F.col("field_name") == f, F.col("first"))).alias(f) for f in ("raw_text", "wikitext")}
    firsts = ends.groupBy("volume", "page_number").agg(*word.values())
    after = next_known(firsts, ["volume"], ["page_number"], F.struct("raw_text", "wikitext"), "following").select("volume", "page_number", "following")
    opened = ends.where(F.col("open").isNotNull()).join(after, ["volume", "page_number"])
    here, there = F.col("following.raw_text"), F.col("following.wikitext")
    following = F.when(F.col("field_name") == "raw_text", F.coalesce(here, there)).otherwise(F.coalesce(there, here))
    opened = opened.select("page_id", "field_name", F.col("open.line_no").alias("line_no"), F.when(F.col("open.cut") == 1, F.concat_ws("-", F.col("open.key"), F.lower(following))).alias("key"))
    inside = notes.where(F.col("note").isin("H", "C")).select(*line, "key")
    hyphen = inside.unionByName(opened).join(compounds, "key", "left").where(F.col("printed").isNull()).select(*line)

    words = notes.where(F.col("note") == "W").join(wrong.withColumnRenamed("word", "key"), "key")
    where_from = F.pandas_udf(lambda a, b: pd.Series([first_difference(x, y) for x, y in zip(a, b)]), "int")
    place = words.withColumn("at", where_from("key", "right"))
    read = place.select("page_id", "field_name", F.when(F.col("second").isNotNull() & (F.col("at") >= F.col("cut")), F.col("second")).otherwise(F.col("line_no")).alias("line_no"))
    misread = read.unionByName(notes.where(F.col("note") == "M").select(*line)).unionByName(out_of_context(notes, contested, contexts))
    said = hyphen.withColumn("kind", F.lit("hyphen")).unionByName(misread.withColumn("kind", F.lit("misread")))
    said = said.join(furniture.distinct(), line, "left_anti")
    found = said.unionByName(furniture.withColumn("kind", F.lit("furniture"))).distinct()
    return found, wrong, notes


def long_pages(source_pages: DataFrame) -> DataFrame:
    """A row for each text of a page, ``raw_text`` and ``wikitext``."""
    fields = F.array(*[F.struct(F.lit(name).alias("field_name"), F.col(name).alias("text")) for name in ("raw_text", "wikitext")])
    rows = source_pages.where(F.col("id").isNotNull()).select(F.col("id").alias("page_id"), "volume", "page_number", F.explode(fields).alias("t"))
    return rows.select("page_id", "volume", "page_number", "t.field_name", "t.text").where(F.col("t.text").isNotNull())


def paragraphs(pages: DataFrame) -> DataFrame:
    """The running text in whole paragraphs: ``volume, field_name, first_page, paragraph_no, last_page, text``.

    Furniture is gone, cut words are whole, misread forms are replaced where the right one is known.
    A paragraph begins after a blank line or at an indented line and may go on over pages; its number
    counts those that begin in its first page (0 for text before the first beginning of a volume).
    Every page is mended and divided where it meets its notes; only what stands at a page's beginning or
    end is brought together over pages.  Pages of equal number follow each other by id.
    """
    found, wrong, notes = noise(pages)
    page = ["page_id", "field_name"]
    gone = found.where(F.col("kind") == "furniture").select(*page, F.col("line_no").alias("gone"))
    cut = found.where(F.col("kind") == "hyphen").select(*page, F.col("line_no").alias("cut"))
    fixes = notes.where((F.col("note") == "W") & F.col("second").isNull()).join(wrong.withColumnRenamed("word", "key"), "key").select(*page, F.struct("line_no", "key", "right").alias("fix"))
    marks = gone.unionByName(cut, True).unionByName(fixes, True).groupBy(*page).agg(F.collect_set("gone").alias("gone"), F.collect_set("cut").alias("cut"), F.collect_set("fix").alias("fixes"))
    once = pages.dropDuplicates(page)

    @F.pandas_udf("array<struct<starts:boolean,piece:string>>")
    def divided(texts: pd.Series, gone: pd.Series, cut: pd.Series, fixes: pd.Series) -> pd.Series:
        return pd.Series([divide(t, *[() if x is None else x for x in marks]) for t, *marks in zip(texts, gone, cut, fixes)], dtype=object)

    place = ["volume", "field_name", "page_number", "page_id"]
    cutup = once.join(marks, page, "left").select(*place, divided("text", "gone", "cut", "fixes").alias("pieces"))
    cutup = cut_lineage(cutup.where(F.size("pieces") > 0)).withColumn("n", F.size(F.filter("pieces", lambda p: p["starts"]))).withColumn("first", F.col("pieces")[0]["starts"].cast("int"))
    # where the paragraph begins that a page's first piece goes on with: the last beginning in the pages before
    begins = F.when((F.col("at") == 1) & (F.col("n") > 0), F.struct("page_number", "page_id", "n"))
    twice = cutup.select(*place, "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("at"))
    begun = last_known(twice, place[:2], [*place[2:], "at"], begins, "begun").where("at = 0").select("page_id", "field_name", "begun")
    rows = cutup.select(*place, "n", "first", F.posexplode("pieces").alias("pos", "p")).select(*place, "n", (F.col("pos") + F.col("first")).alias("no"), "p.*")
    whole = rows.where("starts AND no < n").select("volume", "field_name", F.col("page_number").alias("first_page"), F.col("no").alias("paragraph_no"), F.col("page_number").alias("last_page"), F.trim("piece").alias("text"))
    last = rows.where("starts AND no = n").withColumn("begun", F.struct("page_number", "page_id", "n"))
    onward = rows.where("NOT starts").join(begun, page)
    parts = last.unionByName(onward).groupBy("volume", "field_name", "begun").agg(
        F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page"), F.array_sort(F.collect_list(F.struct("page_number", "page_id", "piece"))).alias("pieces")
    )
    text = F.trim(F.array_join(F.transform("pieces", lambda p: p["piece"]), ""))
    return whole.unionByName(parts.select("volume", "field_name", "first_page", F.coalesce("begun.n", F.lit(0)).alias("paragraph_no"), "last_page", text.alias("text")))


_BEGINS = re.compile(r"\s{2,}\S")
_SIGN_AT_END = re.compile(rf"[{HYPHENS}]\s*$")
_PRINTED = re.compile(r"\w-$")


def divide(text: str, gone: Iterable[int], cut: Iterable[int], fixes: Iterable[dict]) -> list[dict]:
    """The paragraphs of a page, ``starts`` (false only of the first, which goes on with the page before) and ``piece``.

    Lines ``gone`` are left out, lines ``cut`` lose their hyphen and the space after it, and words are replaced by ``fixes``.
    """
    lost, broken = set(gone), set(cut)
    right: dict[int, dict[str, str]] = {}
    for fix in fixes:
        right.setdefault(fix["line_no"], {})[fix["key"]] = fix["right"]
    pieces: list[dict] = []
    blank = False
    for no, line in enumerate((text or "").split("\n"), 1):
        if no in lost:
            continue
        if not line.strip():
            blank = True
            continue
        if no in right:
            line = _WORD.sub(lambda w: _mended(w.group(), right[no]), line)  # noqa: B023 (run at once)
        starts, blank, bare = blank or bool(_BEGINS.match(line)), False, line.strip()
        if no in broken:
            bare = _SIGN_AT_END.sub("", bare)
        elif not _PRINTED.search(bare):  # a word printed with a hyphen goes on as it is
            bare += " "
        if starts or not pieces:
            pieces.append({"starts": starts, "piece": bare})
        else:
            pieces[-1]["piece"] += bare
    return pieces


def _mended(token: str, fixes: dict[str, str]) -> str:
    """The token with its misread word replaced, in its own case and punctuation."""
    word = clean(token)
    right = fixes.get(fold(word))
    if not right:
        return token
    if word.isupper():
        right = right.upper()
    elif word[:1].isupper() or (word[:1] == "l" and fold(word)[1:] == right[1:] and right[0] == "i"):
        right = right[:1].upper() + right[1:]
    return token.replace(word, right)
