"""Personal names as people type them."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

#: Titles and suffixes that are no part of a name.
TITLES = frozenset("sir dame dr doctor prof professor rev revd reverend hon the capt captain col colonel gen general maj major lieut lord lady mr mrs miss esq esqre bart jun junr sen senr very right rt".split())
#: Particles that belong to a surname.
PARTICLES = frozenset("van von de du der den di da la le ten ter zu".split())
#: Familiar and shortened forms whose spelling does not show the name they stand for.
NICKNAMES = {
    "bill": "william", "billy": "william", "will": "william", "willy": "william", "wm": "william",
    "bob": "robert", "bobby": "robert", "rob": "robert", "dick": "richard", "rick": "richard",
    "ned": "edward", "ted": "edward", "teddy": "edward", "harry": "henry", "hal": "henry", "hy": "henry",
    "jack": "john", "jno": "john", "jim": "james", "jimmy": "james", "jas": "james", "joe": "joseph",
    "tom": "thomas", "tommy": "thomas", "sandy": "alexander", "alec": "alexander", "sasha": "alexander",
    "gus": "augustus", "archie": "archibald", "larry": "lawrence", "lorry": "lawrence", "kit": "christopher",
    "chris": "christopher", "xtopher": "christopher", "peggy": "margaret", "meg": "margaret", "maggie": "margaret",
    "madge": "margaret", "bessie": "elizabeth", "betty": "elizabeth", "betsy": "elizabeth", "lizzie": "elizabeth",
    "beth": "elizabeth", "kitty": "katharine", "kate": "katharine", "kathy": "katharine", "dolly": "dorothea",
    "dora": "dorothea", "nell": "eleanor", "nelly": "eleanor", "ellie": "eleanor", "nora": "eleanor",
    "pepe": "jose", "pip": "philip", "brose": "ambrose", "gunni": "gunther", "charley": "charles",
    "charlie": "charles", "georgie": "george", "hughie": "hugh", "gerry": "gerald", "jerry": "gerald",
    "wat": "walter", "wally": "walter", "len": "leonard", "lenny": "leonard", "nat": "nathaniel", "matty": "matthew",
    "freddy": "frederick", "fritz": "frederick", "danny": "daniel", "sammy": "samuel", "benny": "benjamin", "teo": "theodore",
}


def fold(text: str) -> str:
    """Lower case without accents, soft hyphens and invisible characters."""
    if text.isascii() and text.isprintable():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf").lower()


def edits(a: str, b: str, most: int = 1) -> int:
    """Edits between two words (insertion, deletion, change, exchange of neighbours), or ``most + 1`` if more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            value = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if before and j > 1 and x == b[j - 2] and a[i - 2] == y:
                value = min(value, before[j - 2] + 1)
            new.append(value)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


def shortens(short: str, full: str) -> bool:
    """Whether a written abbreviation may stand for the name: same first letter, its letters in order."""
    if len(short) < 2 or len(short) >= len(full) or short[0] != full[0]:
        return False
    rest = iter(full)
    return all(c in rest for c in short)


@lru_cache(maxsize=200_000)
def given_likeness(a: str, b: str) -> float:
    """How well two folded forenames go together: 1 the same, 0 not at all.

    Initials, familiar forms, abbreviations and one slip of the pen go together; two different full
    names do not.
    """
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    for x in {a, NICKNAMES.get(a, a)}:
        for y in {b, NICKNAMES.get(b, b)}:
            if x == y:
                return 0.95
    if len(a) == 1 or len(b) == 1:
        return 0.6 if a[0] == b[0] or NICKNAMES.get(a, a)[0] == NICKNAMES.get(b, b)[0] else 0.0
    if min(len(a), len(b)) >= 3 and edits(a, b, 1) <= 1:
        return 0.9
    if min(len(a), len(b)) >= 7 and edits(a, b, 2) <= 2:
        return 0.8
    for x, y in ((a, b), (b, a)):
        full = NICKNAMES.get(y, y)
        if len(full) >= 4 and shortens(x, full) and (len(x) <= 6 or full.startswith(x)):
            return 0.85
    return 0.0


_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+")


def words(text: str) -> list[str]:
    """Folded words; an apostrophe inside a word is dropped."""
    return [w.replace("'", "").replace("’", "") for w in _WORD.findall(fold(text))]


#: Letters as strokes, so that what a scan or a hasty reader confuses looks the same.
STROKES = (
    ("ﬁ", "fi"), ("ﬂ", "fl"), ("vv", "w"), ("m", "|||"), ("w", "vv"), ("n", "||"), ("u", "||"), ("h", "||"), ("d", "c|"),
    ("i", "|"), ("l", "|"), ("r", "|"), ("1", "|"), ("e", "c"), ("f", "t"), ("ſ", "s"), ("5", "s"), ("0", "o"), ("6", "b"), ("8", "b"), ("9", "g"), ("@", "a"),
)


def skeleton(word: str) -> str:
    """The strokes of a folded word: confusable spellings have the same."""
    for letter, strokes in STROKES:
        word = word.replace(letter, strokes)
    return word
