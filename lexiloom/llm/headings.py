"""Problem 4: mapping free-entered values to a canonical list.

The list is a trie of letters.  An entry is filed under its core (a place without *river* or *duchy
of*, a surname, the two words of a subject) and under alias paths (the words in the other order).  A
value is taken apart in the same way, and its core is run through the trie by a Levenshtein automaton
with exchanges: a bit set of the core's positions for each number of errors, advanced along the
trie's arcs, so that all entries within the distance that the length allows come back from one walk.
What was taken off the core then has to agree with the entry.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.names import TITLES, edits, fold, given_likeness, words
from lexiloom.session import cut_lineage

#: Entries that are broadcast at once; a longer list is searched in several passes.
MOST_ENTRIES = 50_000
#: Words that qualify a name, and what they say.
QUALIFIERS = {
    "river": "river", "r": "river", "riv": "river", "town": "town", "tow": "town", "city": "town", "port": "town", "t": "town", "village": "town",
    "duchy": "duchy", "kingdom": "kingdom", "principality": "principality", "bishopric": "bishopric", "county": "county", "province": "province",
    "bish": "bishopric", "king": "kingdom", "princ": "principality", "prin": "principality", "du": "duchy", "duch": "duchy", "kingd": "kingdom",
    "saint": "saint", "st": "saint", "ste": "saint", "s": "saint",
}
_LONG = {w: q for w, q in QUALIFIERS.items() if len(w) >= 4}
_WRAPPED = re.compile(r"^«[A-Z]+:([^|»]*)(?:\|[^»]*)?»$")
_CUE = re.compile(r"^\(?\s*(?:see\s+also|see|cf\.?|vide|v\.|q\.\s*v\.)\s+(.*?)\)?\s*$", re.I | re.S)
_MARK = re.compile(r"\(\s*q\.?\s*v\.?\s*\)", re.I)
_SECTION = re.compile(r"[#:§].*$", re.S)


def unwrap(text: str) -> str:
    """What the editor named: without link marks, *see*, *(q.v.)* and a section."""
    text = text.strip()
    m = _WRAPPED.match(text)
    text = m.group(1) if m else text
    m = _CUE.match(text)
    text = m.group(1) if m else text
    return _SECTION.sub("", _MARK.sub(" ", text))


def letters(text: str) -> str:
    return "".join(words(text))


def allowed(length: int) -> int:
    """Errors allowed in a core of so many letters."""
    return 0 if length < 4 else 1 if length < 14 else 2


@lru_cache(maxsize=200_000)
def qualifier(word: str) -> str | None:
    """What a word says of a name, one slip of the pen allowed in a long one."""
    found = QUALIFIERS.get(word)
    if found or len(word) < 4:
        return found
    for known, said in _LONG.items():
        if (len(word) >= 5 and known.startswith(word) and len(known) > 5) or edits(word, known, 1) <= 1:
            return said
    return None


@dataclass
class Reading:
    """One way to take a value apart."""

    core: str
    said: str | None = None  # the qualifier
    given: tuple[str, ...] | None = None  # forenames, if it is read as a person


@dataclass
class Entry:
    id: int
    full: str  # its letters, in the list's order
    said: str | None
    given: tuple[str, ...] | None


def readings(text: str) -> list[Reading]:
    """The ways to read an unwrapped value, the likelier first."""
    plain = fold(text)
    tokens = words(text)
    while tokens and tokens[0] == "the":
        tokens = tokens[1:]
    if not tokens or any(t.isdigit() for t in tokens):
        return []
    out: list[Reading] = [Reading("".join(tokens))]
    # a qualifier at either end, with or without "of"
    for inner, end in ((tokens[1:], tokens[0]), (tokens[:-1], tokens[-1])):
        rest = [t for t in inner if t != "of"]
        said = qualifier(end)
        if said and rest:
            out.append(Reading("".join(rest), said))
    if tokens[-1] == "of" and len(tokens) > 2 and (said := qualifier(tokens[-2])):
        out.append(Reading("".join(tokens[:-2]), said))
    comma = plain.find(",")
    if comma > 0:
        first, second = words(plain[:comma]), words(plain[comma + 1 :])
        if first and second:
            out.append(Reading("".join([*second, *first])))
    elif len(tokens) == 2:
        out.append(Reading(tokens[1] + tokens[0]))
    # a person: one word is the surname, the others are forenames
    named = [t for t in tokens if t not in TITLES]
    if named:
        if comma > 0:
            first, second = [t for t in words(plain[:comma]) if t not in TITLES], [t for t in words(plain[comma + 1 :]) if t not in TITLES]
            out.append(Reading("".join(first), given=tuple(second)))
        else:
            places = [len(named) - 1, 0] if len(named) > 1 else [0]
            out += [Reading(named[i], given=tuple(t for k, t in enumerate(named) if k != i)) for i in places if len(named[i]) > 3]
            if len(named) > 2:  # a surname broken in two
                out.append(Reading(named[-2] + named[-1], given=tuple(named[:-2])))
    return out


class Trie:
    """Cores of the entries; a node is a dict of its arcs, and ends are kept beside it."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.ends: dict[int, list[int]] = {}
        self.left: list[int] = [0]  # bit n: a path goes on for n more letters to an end

    def add(self, path: str, value: int) -> None:
        node, left = 0, self.left
        for i, c in enumerate(path):
            left[node] |= 1 << len(path) - i
            at = self.arcs[node].get(c)
            if at is None:
                at = self.arcs[node][c] = len(self.arcs)
                self.arcs.append({})
                left.append(0)
            node = at
        left[node] |= 1
        values = self.ends.setdefault(node, [])
        if value not in values:
            values.append(value)

    def exact(self, path: str) -> list[int]:
        node = 0
        for c in path:
            node = self.arcs[node].get(c, -1)
            if node < 0:
                return []
        return self.ends.get(node, [])

    def beneath(self, path: str) -> list[int]:
        """Values of all paths that go on after this one."""
        node = 0
        for c in path:
            node = self.arcs[node].get(c, -1)
            if node < 0:
                return []
        out, stack = [], [node]
        while stack:
            node = stack.pop()
            out += self.ends.get(node, [])
            stack += self.arcs[node].values()
        return out

    def near(self, word: str, most: int, floors: tuple[int, ...] | None = None) -> list[tuple[int, int]]:
        """``(distance, value)`` of every path within ``most`` errors of the word.

        With ``floors``, of those that are at position ``floors[d]`` or later when they have ``d`` errors.
        """
        size = len(word)
        late = [-1 << f for f in floors or (0,) * (most + 1)]
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        limit, last = (1 << size + 1) - 1, 1 << size
        start = tuple((1 << d + 1) - 1 & late[d] for d in range(most + 1))
        empty = (0,) * (most + 1)
        best: dict[int, int] = {}
        stack = [(0, start, empty, 0, size)]  # node, positions by errors, those before the last arc, mask of the last arc, letters that should follow
        arcs, ends, left = self.arcs, self.ends, self.left
        band = (1 << 2 * most + 1) - 1
        while stack:
            node, now, before, mask, rest = stack.pop()
            if node in ends:
                for d in range(most + 1):
                    if now[d] & last:
                        for value in ends[node]:
                            if best.get(value, most + 1) > d:
                                best[value] = d
                        break
            shift = rest - 1 - most
            window = band << shift if shift >= 0 else band >> -shift
            for c, child in arcs[node].items():
                if not left[child] & window:  # no path beneath is of a length that fits
                    continue
                m = masks.get(c, 0)
                row = [(now[0] & m) << 1]
                for d in range(1, most + 1):
                    low = now[d - 1]
                    row.append(((now[d] & m) << 1 | low | low << 1 | row[d - 1] << 1 | (before[d - 1] & m & mask >> 1) << 2) & limit & late[d])
                if any(row):
                    stack.append((child, tuple(row), now, m, rest - 1))
        return [(d, v) for v, d in best.items()]


    def near_one(self, word: str) -> list[tuple[int, int]]:
        """``near(word, 1, (0, len(word) // 2))``, the commonest case, with its two sets of positions by name."""
        size = len(word)
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        limit, last, late = (1 << size + 1) - 1, 1 << size, -1 << size // 2
        late &= limit
        arcs, ends, left = self.arcs, self.ends, self.left
        best: dict[int, int] = {}
        stack = [(0, 1, 3 & late, 0, 0, size)]  # node, positions without and with an error, those without before the last arc, its mask, letters that should follow
        while stack:
            node, none, one, before, mask, rest = stack.pop()
            if node in ends and (none | one) & last:
                distance = 0 if none & last else 1
                for value in ends[node]:
                    if best.get(value, 2) > distance:
                        best[value] = distance
            shift = rest - 2
            window = 7 << shift if shift >= 0 else 7 >> -shift
            skipped, exchanged = none | none << 1, before & mask >> 1
            for c, child in arcs[node].items():
                m = masks.get(c, 0)
                kept = (none & m) << 1
                slipped = ((one & m) << 1 | skipped | kept << 1 | (exchanged & m) << 2) & late
                if (kept or slipped) and left[child] & window:
                    stack.append((child, kept, slipped, none, m, rest - 1))
        return [(d, v) for v, d in best.items()]


class TwoWay:
    """The trie of paths and that of the paths read backwards.

    One error is met after the middle in one of the two directions.  Of two errors, either none is in
    the first third in one direction, or one is there and the other in the last third.  So all walks
    keep close to single paths for a part of the word.
    """

    def __init__(self) -> None:
        self.onward, self.backward = Trie(), Trie()

    def add(self, path: str, value: int) -> None:
        self.onward.add(path, value)
        self.backward.add(path[::-1], value)

    def near(self, word: str, most: int) -> list[tuple[int, int]]:
        """As of ``Trie``, all within the distance."""
        best: dict[int, int] = {}
        if most == 1:
            found = self.onward.near_one(word) + self.backward.near_one(word[::-1])
        elif most == 2:
            third = len(word) // 3
            ends = (0, third, third)
            found = self.onward.near(word, 2, ends) + self.backward.near(word[::-1], 2, ends) + self.onward.near(word, 2, (0, 0, len(word) - third))
        else:
            found = self.onward.near(word, most)
        for d, v in found:
            best[v] = min(d, best.get(v, d))
        return [(d, v) for v, d in best.items()]


@dataclass
class Canon:
    """The list as a trie of cores and one of whole entries."""

    entries: list[Entry]
    cores: TwoWay = field(default_factory=TwoWay)
    wholes: Trie = field(default_factory=Trie)
    memory: dict[str, list[tuple[int, int]]] = field(default_factory=dict)
    matched: dict[str, tuple[float, int] | None] = field(default_factory=dict)
    longest: int = 0  # letters of the longest core

    @classmethod
    def of(cls, rows: Iterable[tuple[int, str, str | None]]) -> Canon:
        """From rows ``(id, heading, category)``; rows without id or letters are no entries."""
        canon = cls([])
        for id_, heading, category in sorted((r for r in rows if r[0] is not None and r[1] and letters(r[1])), key=lambda r: r[0]):
            canon._add(id_, heading, category)
        return canon

    def _add(self, id_: int, heading: str, category: str | None) -> None:
        tokens, index = words(heading), len(self.entries)
        said, given, core = None, None, "".join(tokens)
        aliases: list[str] = []
        if tokens[0] == "saint" and len(tokens) > 1:
            said, core = "saint", "".join(tokens[1:])
        elif category == "biography" and "," in heading:
            surname, _, rest = heading.partition(",")
            core, given = letters(surname), tuple(words(rest))
        elif len(tokens) > 1 and tokens[-1] in QUALIFIERS and "(" in heading:
            said, core = QUALIFIERS[tokens[-1]], "".join(tokens[:-1])
        elif len(tokens) > 2 and tokens[-1] == "of" and tokens[-2] in QUALIFIERS:
            said, core = QUALIFIERS[tokens[-2]], "".join(tokens[:-2])
        elif len(tokens) == 2:
            aliases.append(tokens[1] + tokens[0])
        self.entries.append(Entry(id_, "".join(tokens), said, given))
        for path in (core, *aliases):
            self.cores.add(path, index)
            self.longest = max(self.longest, len(path))
        self.wholes.add("".join(tokens), index)

    def _cores(self, core: str) -> list[tuple[int, int]]:
        known = self.memory.get(core)
        if known is None:
            exact = self.cores.onward.exact(core)
            most = allowed(len(core))
            known = self.cores.near(core, most) if most else [(0, v) for v in exact]
            if len(self.memory) > 200_000:
                self.memory.clear()
            self.memory[core] = known
        return known

    def within(self, text: str | None) -> list[tuple[int, int]]:
        """``(distance, id)`` of every entry that a reading of the value reaches, the nearest first; each entry by its least distance.

        The distance is that of the cores; what was taken off the core is not compared here.
        """
        best: dict[int, int] = {}
        for reading in readings(unwrap(text)) if text else []:
            if len(reading.core) <= self.longest + 2:
                for distance, index in self._cores(reading.core):
                    best[index] = min(distance, best.get(index, distance))
        return sorted((d, self.entries[i].id) for i, d in best.items())

    def match(self, text: str | None) -> tuple[float, int] | None:
        """The cost and the entry that a value means best; None if it means none."""
        if not text:
            return None
        if text not in self.matched:
            if len(self.matched) > 100_000:
                self.matched.clear()
            self.matched[text] = self._match(text)
        return self.matched[text]

    def _match(self, text: str) -> tuple[float, int] | None:
        best: tuple[float, int] | None = None
        for reading in readings(unwrap(text)):
            if len(reading.core) > self.longest + 2:
                continue
            for distance, index in self._cores(reading.core):
                cost = self._cost(reading, self.entries[index])
                if cost is not None and (best is None or (distance + cost, index) < best):
                    best = (distance + cost, index)
            if best is not None and best[0] == 0:
                break
        return best

    @staticmethod
    def _cost(reading: Reading, entry: Entry) -> float | None:
        """What the rest of a reading adds to the distance; None if it speaks of something else."""
        if entry.given is not None:
            if reading.given is None:
                # a bare surname may be a person's whose forenames were cut off
                return 0.9 if reading.said is None else None
            return _given_cost(reading.given, entry.given)
        if reading.given:
            return None
        if reading.said == entry.said:
            return 0.0
        if reading.said == "town" and entry.said is None:
            return 0.1
        if reading.said is None and entry.said not in (None, "saint"):
            return 0.7
        return None

    def cut_off(self, text: str | None) -> list[int]:
        """Entries of which the value is a beginning of four letters or more."""
        core = letters(unwrap(text)) if text else ""
        return self.wholes.beneath(core) if len(core) >= 4 else []

    def resolve(self, normalized: str | None, surface: str | None) -> int:
        """The id that the two fields mean together; 0 for none."""
        return settle(self.evidence(normalized, surface), normalized, surface)

    def evidence(self, normalized: str | None, surface: str | None) -> tuple:
        """What this list offers for the two fields: cost and id of either's best entry, and the least id the first is cut off from."""
        n, s = self.match(normalized), self.match(surface)
        below = min((self.entries[i].id for i in self.cut_off(normalized)), default=0) if n is None and not (surface and letters(unwrap(surface))) else 0
        return (*((n[0], self.entries[n[1]].id) if n else (None, 0)), *((s[0], self.entries[s[1]].id) if s else (None, 0)), below)


def settle(found: tuple, normalized: str | None, surface: str | None) -> int:
    """The id that the best of each field come to; 0 for none.

    The normalized field decides where it names an entry exactly.  Where it is only the beginning
    of what the surface says, the surface decides alone; otherwise the nearer one does.
    """
    n_cost, n_id, s_cost, s_id, below = found
    whole = letters(unwrap(surface)) if surface else ""
    part = letters(unwrap(normalized)) if normalized else ""
    if whole and part and len(part) < len(whole) and whole.startswith(part) and len(part) >= 3:
        if s_cost is not None or n_cost is None or n_cost > 0:
            return s_id if s_cost is not None else 0
    if n_cost is not None and (s_cost is None or n_cost <= s_cost):
        return n_id
    return s_id if s_cost is not None else below


def nearest(offers: Iterable[tuple]) -> tuple:
    """The offers of several parts of a list as one: the least cost of each field, the least id where costs are equal."""
    offers = list(offers)
    best = []
    for at in (0, 2):
        least = min(((o[at], o[at + 1]) for o in offers if o[at] is not None), default=(None, 0))
        best += least
    return (*best, min((o[4] for o in offers if o[4]), default=0))


def _given_cost(said: tuple[str, ...], named: tuple[str, ...]) -> float | None:
    said = tuple(t for t in said if t not in TITLES)
    if not said:
        return 0.9
    if len(said) > len(named):
        return None
    cost = 0.3 * (len(named) - len(said))
    for at, (a, b) in enumerate(zip(said, named)):
        likeness = given_likeness(a, b)
        if likeness == 0 and at == len(said) - 1 and b.startswith(a):
            likeness = 0.5
        if likeness == 0:
            return None
        cost += (1 - likeness) * 0.5
    return cost


_OFFER = "n_cost double, n_id bigint, s_cost double, s_id bigint, below bigint"


def _resolver(shared):
    """The map of the distinct pairs to ids, where the whole list is at hand."""

    @F.pandas_udf("bigint")
    def resolve(normalized: pd.Series, surface: pd.Series) -> pd.Series:
        canon = shared.value
        return pd.Series([canon.resolve(*pair) for pair in zip(normalized, surface)], dtype="int64")

    return resolve


def map_to_list(df: DataFrame, normalized: str, surface: str, headings: DataFrame, out: str = "heading_id", most_entries: int = MOST_ENTRIES) -> DataFrame:
    """``df`` with ``out``: the id of the heading that the two text columns mean, 0 for none.

    The distinct pairs of texts are resolved, and a row gets the id of its pair; pairs that hold an
    outsized share of the rows are not shuffled to one task.  ``headings`` has ``heading_id, heading,
    category``; its length is checked.  Up to ``most_entries`` it is broadcast as one trie.  A longer
    list is searched in parts of about that many entries, one after the other: each part offers its
    best for either field, and the least cost of all parts decides, as it does within one part (the
    least id where costs are equal).  Rows whose two texts are null give 0; a column named ``out`` is
    replaced.
    """
    spark = df.sparkSession
    listed = headings.where(F.col("heading_id").isNotNull()).select("heading_id", "heading", "category")
    total = listed.count()
    df = df.drop(out)
    key = "__pair"
    # a null and an empty text are told apart
    keyed = df.withColumn(key, F.xxhash64(F.coalesce(F.concat(F.lit("="), normalized), F.lit("")), F.coalesce(F.concat(F.lit("="), surface), F.lit(""))))
    pairs = keyed.groupBy(F.col(normalized).alias("n"), F.col(surface).alias("s"), key).agg(F.count(F.lit(1)).alias("rows"))
    if total <= most_entries:
        shared = spark.sparkContext.broadcast(Canon.of([tuple(r) for r in listed.collect()]))
        found = pairs.withColumn(out, _resolver(shared)("n", "s"))
    else:
        found = _in_parts(cut_lineage(pairs), listed, -(-total // most_entries), out)
    found = cut_lineage(found.select(key, F.col("n").alias("__n"), F.col("s").alias("__s"), out, "rows"))
    return left_join_pairs(keyed, found, key, normalized, surface, out)


def candidates(df: DataFrame, value: str, headings: DataFrame, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """Columns ``value, heading_id, distance``: for each distinct value all entries within the distance its length allows.

    A list longer than ``most_entries`` is walked in parts, one broadcast at a time.  Null values and
    values that no entry is near have no row.
    """
    spark = df.sparkSession
    listed = headings.where(F.col("heading_id").isNotNull()).select("heading_id", "heading", "category")
    parts = max(1, -(-listed.count() // most_entries))
    values = df.select(value).where(F.col(value).isNotNull()).distinct()
    out = None
    for i in range(parts):
        part = [tuple(r) for r in listed.where(F.pmod(F.xxhash64("heading_id"), F.lit(parts)) == i).collect()]
        shared = spark.sparkContext.broadcast(Canon.of(part))

        @F.pandas_udf("array<struct<distance:int,heading_id:bigint>>")
        def near(texts: pd.Series) -> pd.Series:
            return pd.Series([[{"distance": d, "heading_id": v} for d, v in shared.value.within(t)] for t in texts], dtype=object)  # noqa: B023 (run before the next part)

        found = values.select(value, F.explode(near(value)).alias("e")).select(value, "e.heading_id", "e.distance")
        if parts > 1:
            found = cut_lineage(found)
            shared.unpersist()
        out = found if out is None else out.unionByName(found)
    return out


def left_join_pairs(keyed: DataFrame, found: DataFrame, key: str, normalized: str, surface: str, out: str) -> DataFrame:
    """Each row with the id of its pair; the few pairs of an outsized share of the rows are broadcast.

    At most 1,000 pairs can hold a thousandth of the rows each, which bounds what is broadcast.
    """
    total = found.agg(F.sum("rows")).first()[0] or 0
    least = max(1_000, total // 1_000)
    hot, cold = found.where(F.col("rows") >= least), found.where(F.col("rows") < least)
    same = [F.col("__n").eqNullSafe(F.col(normalized)), F.col("__s").eqNullSafe(F.col(surface))]
    names = [c for c in keyed.columns if c != key]
    marked = keyed.join(F.broadcast(hot.select(F.col(key).alias("__k"), "__n", "__s", F.col(out).alias("__hot"))), [F.col(key) == F.col("__k"), *same], "left").drop("__k", "__n", "__s")
    done = marked.where(F.col("__hot").isNotNull()).select(*names, F.col("__hot").alias(out))
    rest = marked.where(F.col("__hot").isNull()).drop("__hot").join(cold.select(F.col(key).alias("__k"), "__n", "__s", out), [F.col(key) == F.col("__k"), *same]).select(*names, out)
    return done.unionByName(rest)


def _in_parts(pairs: DataFrame, listed: DataFrame, parts: int, out: str) -> DataFrame:
    """The pairs with the id that the offers of all parts of the list come to; one part is broadcast at a time."""
    spark = pairs.sparkSession
    kind = "array<struct<" + ",".join(c.replace(" ", ":") for c in _OFFER.split(", ")) + ">>"
    pairs = pairs.withColumn("offers", F.lit(None).cast(kind))
    for i in range(parts):
        part = [tuple(r) for r in listed.where(F.pmod(F.xxhash64("heading_id"), F.lit(parts)) == i).collect()]
        shared = spark.sparkContext.broadcast(Canon.of(part))

        @F.pandas_udf(_OFFER)
        def offer(normalized: pd.Series, surface: pd.Series) -> pd.DataFrame:
            rows = [shared.value.evidence(*pair) for pair in zip(normalized, surface)]  # noqa: B023 (run before the next part)
            return pd.DataFrame(rows, columns=[c.split()[0] for c in _OFFER.split(", ")]).astype({"n_cost": "float64", "s_cost": "float64"})

        pairs = cut_lineage(pairs.withColumn("offers", F.concat(F.coalesce("offers", F.array().cast(kind)), F.array(offer("n", "s")))))
        shared.unpersist()

    @F.pandas_udf("bigint")
    def decide(normalized: pd.Series, surface: pd.Series, offers: pd.Series) -> pd.Series:
        ids = []
        for n, s, rows in zip(normalized, surface, offers):
            kept = [tuple(None if v is None or v != v else v for v in (r["n_cost"], r["n_id"], r["s_cost"], r["s_id"], r["below"])) for r in rows]
            ids.append(settle(nearest(kept), n, s))
        return pd.Series(ids, dtype="int64")

    return pairs.withColumn(out, decide("n", "s", "offers")).drop("offers")
