"""Text functions as column expressions.

They stay in the JVM; patterns use the syntax that Java and RE2 share, so that SQL can check them.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.functions.types import STRING


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


@cache
def _accents() -> tuple[str, str]:
    """Letters with accents and the plain ones, from the Unicode tables; marks without a partner are dropped."""
    accented, plain = [], []
    for point in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(point)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(point):
            accented.append(chr(point))
            plain.append(base)
    marks = [chr(p) for p in range(0x300, 0x370)]
    return "".join(accented + marks), "".join(plain)


def fold_accents(text: Column | str) -> Column:
    """Letters without their accents; case and everything else stay."""
    return F.translate(_col(text), *_accents())


def slug(text: Column | str) -> Column:
    """Lower-case letters and digits, anything else between them one hyphen."""
    return F.trim(F.regexp_replace(F.lower(F.trim(_col(text))), "[^a-z0-9]+", "-"), F.lit("-"))


def digest(text: Column | str, length: int | None = 16) -> Column:
    """SHA-256 in hexadecimal, its first ``length`` digits."""
    whole = F.sha2(_col(text), 256)
    return F.substring(whole, 1, length) if length else whole


def strip_tags(text: Column | str, instead: str = "") -> Column:
    return F.regexp_replace(_col(text), "<[^>]*>", instead)


def collapse_spaces(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(text), r"\s+", " "))


def collapse_key(text: Column | str) -> Column:
    return F.lower(collapse_spaces(text))


def primary_headword(heading: Column | str) -> Column:
    """The term that a heading goes on to describe: without brackets, a sobriquet and what a comma opens."""
    text = F.regexp_replace(strip_markers(heading, ""), r"\s*(\([^()]*\)|\[[^\[\]]*\])", "")
    text = F.regexp_replace(text, r"\s*[(\[].*$", "")
    text = F.regexp_replace(text, r"(?i)\bsurnamed\b.*$", "")
    return collapse_spaces(F.regexp_replace(text, ",.*$", ""))


def excerpt(text: Column | str, at: Column, span: int = 60) -> Column:
    """``span`` characters to either side of the 0-based offset, on one line."""
    start = F.greatest(F.lit(0), at - span)
    part = F.substring(_col(text), start + 1, at + span - start)
    return F.regexp_replace(F.translate(part, "\n", " "), "\r", "")


#: Words that a title leaves in lower case unless they begin or end it.
MINOR_WORDS = "a an and as at but by for from in nor of on or the to up via with".split()


def title_case(text: Column | str) -> Column:
    """Words capitalised, minor ones only at either end; words are divided by spaces."""
    words = F.split(F.lower(_col(text)), " ")
    last = F.size(words) - 1
    minor = F.array(*[F.lit(w) for w in MINOR_WORDS])
    cased = F.transform(words, lambda w, i: F.when(F.array_contains(minor, w) & (i > 0) & (i < last), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1_000_000))))
    return F.array_join(cased, " ")


def page_range(first: Column | str, last: Column | str) -> Column:
    """``p. 4`` or ``pp. 4–6``; a missing end is empty."""
    a, b = (F.coalesce(_col(x).cast("string"), F.lit("")) for x in (first, last))
    return F.when(a == b, F.concat(F.lit("p. "), a)).otherwise(F.concat(F.lit("pp. "), a, F.lit("–"), b))


@F.pandas_udf(STRING)
def nfc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Unicode normal form C, which the JVM functions do not offer."""
    for series in texts:
        yield series.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@F.pandas_udf(STRING)
def nfkc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Unicode normal form KC."""
    for series in texts:
        yield series.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def alias_form(name: Column | str) -> Column:
    """A name as it is stored: normal form KC, straight quotes, single spaces."""
    return collapse_spaces(F.translate(nfkc(_col(name)), "’‘`“”", "'''\"\""))


def canonical_initials(signature: Column | str) -> Column:
    """One form for a signature: without markup and leading signs, ``A. B.*``, one of each point and star, a full stop at the end, and in runs of capitals only the first."""
    s = F.regexp_replace(_col(signature), r"\{\{[^{}|]*\|(?:[^{}|]*\|)*([^{}|]*)\}\}", "$1")
    s = strip_tags(F.regexp_replace(s, r"\{\{[^{}]*|\}\}", ""))
    s = F.regexp_replace(s, "&(thin|em|en|nb)sp;", " ")
    s = F.regexp_replace(s, "^[✠✝†*\\s]+", "")
    for pattern, instead in ((r"\*\s*\.|\.\s*\*", ".*"), (r"\*+", "*"), (r"\.+", "."), (r"\.([A-Za-z])", ". $1")):
        s = F.regexp_replace(s, pattern, instead)
    s = collapse_spaces(s)
    s = F.when(s.rlike(r"\p{L}$"), F.concat(s, F.lit("."))).otherwise(s)
    return F.array_join(F.transform(F.split(s, " "), lambda w: F.when(w.rlike(r"^\p{Lu}{2,}\.$"), F.concat(F.substring(w, 1, 1), F.lower(F.substring(w, 2, 1_000_000)))).otherwise(w)), " ")


#: Signs of print and what is read for them, one for one and one for several.
PRINT_SIGNS = ("ſ\xa0  ", "s   ")
PRINT_GROUPS = (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"))


def print_artifacts(text: Column | str) -> Column:
    """Long s, ligatures and odd spaces as plain letters and spaces."""
    out = F.translate(_col(text), *PRINT_SIGNS)
    for sign, letters in PRINT_GROUPS:
        out = F.replace(out, F.lit(sign), F.lit(letters))
    return out


def xref_target(text: Column | str) -> Column:
    """The key under which references and filed titles meet: upper case, one typography, no outer dots.

    A prefix before a colon that touches what follows is an interwiki mark and goes; ``#`` begins a
    section as ``: `` does.
    """
    out = collapse_spaces(text)
    out = F.regexp_replace(out, r"^[^\s:]+:(\S)", "$1")
    out = F.replace(F.upper(F.regexp_replace(out, r"\s*#\s*", ": ")), F.lit("Æ"), F.lit("AE"))
    out = F.translate(out, "’‘ʼ´`", "'''''")
    out = F.regexp_replace(out, "[“”\"]", "")
    out = F.translate(F.regexp_replace(out, "[-‐‑‒–—]", " "), ",", " ")
    return collapse_spaces(F.regexp_replace(out, r"[.\s]+$", ""))


def section_key(text: Column | str) -> Column:
    return F.regexp_replace(F.lower(_col(text)), "[^a-z0-9]+", "")


#: Words that are never what an article is about.
FURNITURE = "OF THE AND SIR ESQ BART HON DR MR MRS MME MLLE MISS REV PROF ST SAINT JR SR MADAME".split()


def word_set(text: Column | str) -> Column:
    """The words in upper case, each once, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.upper(_col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")))


def content_words(text: Column | str) -> Column:
    """The word set of the text without accents, initials and furniture."""
    return F.array_except(F.filter(word_set(fold_accents(text)), lambda w: F.length(w) > 1), F.array(*[F.lit(w) for w in FURNITURE]))


def word_key(words: Column) -> Column:
    """A word set as one string, so that sets can be joined on."""
    return F.array_join(words, "|")


def article_norm(text: Column | str) -> Column:
    """Letters and digits of the text without accents, in upper case."""
    return F.regexp_replace(F.upper(fold_accents(text)), "[^A-Z0-9]+", "")


def within(a: Column | str, b: Column | str, most: int) -> Column:
    """Whether the edit distance is at most ``most``; the computation stops beyond it."""
    return F.levenshtein(_col(a), _col(b), most) >= 0


def suffix_cuts(words: Column) -> Column:
    """All endings of a list of words, the longest first."""
    return F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, i, F.size(words)), " "))).otherwise(F.array().cast("array<string>"))


def word_spans(words: Column, most: int = 12) -> Column:
    """All runs of at most ``most`` words."""
    runs = F.flatten(
        F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.transform(F.sequence(i, F.least(F.size(words), i + most - 1)), lambda j: F.array_join(F.slice(words, i, j - i + 1), " ")))
    )
    return F.when(F.size(words) > 0, runs).otherwise(F.array().cast("array<string>"))


def alternates(text: Column | str) -> Column:
    """Spellings that a text offers: either side of *or*, and what brackets hold and leave."""
    t = _col(text)
    inner, outer = F.regexp_extract(t, r"\(([^()]*)\)", 1), collapse_spaces(F.regexp_replace(t, r"\s*\([^()]*\)", ""))
    return F.filter(F.array_distinct(F.concat(F.array(collapse_spaces(t), outer, F.trim(inner)), F.transform(F.split(outer, r"(?i)\s+or\s+"), F.trim))), lambda s: s != "")


def qualifier(text: Column | str) -> Column:
    """What stands after the last comma or in closing brackets; null if nothing does."""
    t = _col(text)
    bracket, comma = F.regexp_extract(t, r"\(([^()]*)\)\s*$", 1), F.regexp_extract(t, r",\s*([^,]+)$", 1)
    return F.when(bracket != "", bracket).when(comma != "", comma)


#: Titles before a name.
HONORIFICS = "sir rev revd the hon dr prof lord lady capt col general gen major maj very right rt mr mrs miss".split()
_HONORIFIC = r"(?i)^\s*((" + "|".join(HONORIFICS) + r")\b\.?\s*)+"


def strip_honorifics(name: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(name), _HONORIFIC, ""))


def honorific_set(name: Column | str) -> Column:
    """The titles before a name, sorted."""
    head = F.regexp_extract(_col(name), _HONORIFIC, 0)
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(head), r"[\s.]+"), lambda w: w != "")))


def name_key(name: Column | str) -> Column:
    """The words of a name without titles, accents and order."""
    return F.array_join(F.array_sort(F.filter(F.split(F.lower(fold_accents(strip_honorifics(name))), "[^a-z]+"), lambda w: w != "")), " ")


def initials_key(initials: Column | str) -> Column:
    return F.regexp_replace(F.upper(fold_accents(initials)), "[^A-Z]", "")


def contributor_slug(initials: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(fold_accents(initials)), "[^a-z0-9]+", "-"), F.lit("-"))


def surname_fold(name: Column | str) -> Column:
    """A surname in lower case with one spelling of Mac."""
    return F.regexp_replace(F.lower(fold_accents(name)), "^m(['’‘]|ac|c)([a-z]{3,})$", "mc$2")


def invert_name(name: Column | str) -> Column:
    """``Surname, Forenames`` as ``Forenames Surname`` and the other way round."""
    t = F.trim(_col(name))
    comma = F.locate(",", t)
    last = F.element_at(F.split(t, r"\s+"), -1)
    rest = F.trim(F.substring(t, F.lit(1), F.length(t) - F.length(last)))
    return (
        F.when(comma > 0, F.concat(F.trim(F.substring(t, comma + 1, F.length(t))), F.lit(" "), F.trim(F.substring(t, F.lit(1), comma - 1))))
        .when(rest != "", F.concat(last, F.lit(", "), rest))
        .otherwise(t)
    )


def stable_id(volume: Column | str, page: Column | str, title: Column | str) -> Column:
    """``VV-PPPP-`` and six digits of the hash of the title's slug."""
    return F.format_string("%02d-%04d-%s", _col(volume), _col(page), F.substring(F.sha1(slug(title)), 1, 6))


_MARKER = r"«/?[A-Z][A-Za-z0-9_]*(\[[^«»]*\])?(:[^«»]*»|:|»)"


def strip_markers(text: Column | str, instead: str = " ") -> Column:
    """The text without marker tokens; what they enclose stays."""
    return F.regexp_replace(_col(text), _MARKER, instead)


def marker_names(text: Column | str) -> Column:
    """The names of the markers in order."""
    return F.transform(F.regexp_extract_all(_col(text), F.lit("«/?[A-Z][A-Za-z0-9_]*(\\[[^«»]*\\])?(:|»)"), F.lit(0)), lambda m: F.regexp_extract(m, "«/?([A-Za-z0-9_]+)", 1))


def links_to_display(text: Column | str) -> Column:
    """Link markers replaced by what they show: the field after the last bar."""
    return F.regexp_replace(_col(text), r"«(LN|AL|XL)(\[[^«»]*\])?:([^«»|]*\|)*([^«»|]*)(»|«/(LN|AL|XL)»)", "$4")


def plain_text(text: Column | str) -> Column:
    """What a reader reads: footnotes go, links show their display, marks go, paragraphs part."""
    out = F.regexp_replace(_col(text), r"(?s)«FN(\[[^«»]*\])?:.*?«/FN»", "")
    out = F.replace(links_to_display(out), F.lit("«P»"), F.lit(" "))
    return collapse_spaces(strip_markers(out, ""))


def opening(body: Column | str, length: int = 300) -> Column:
    return F.substring(plain_text(body), 1, length)


def prose_window(body: Column | str, surface: Column | str, radius: int = 140) -> Column:
    """``radius`` characters to either side of the surface; null where the body does not have it."""
    at = F.call_function("instr", _col(body), _col(surface))
    start = F.greatest(F.lit(1), at - radius)
    return F.when(at > 0, F.substring(_col(body), start, at + F.length(_col(surface)) + radius - start))


def occurrences(text: Column | str, part: Column | str) -> Column:
    """How often a part stands in a text, without overlaps."""
    t, p = _col(text), _col(part)
    return F.when(F.length(p) > 0, ((F.length(t) - F.length(F.replace(t, p, F.lit("")))) / F.length(p)).cast("int")).otherwise(0)


def escape_html(text: Column | str) -> Column:
    out = _col(text)
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def unescape_html(text: Column | str) -> Column:
    out = _col(text)
    for plain, entity in (('"', "&quot;"), (">", "&gt;"), ("<", "&lt;"), ("&", "&amp;")):
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return out


def media_path(name: Column | str) -> Column:
    """The folder of a file by the first digits of its hash, with spaces as underscores."""
    clean = F.translate(F.trim(_col(name)), " ", "_")
    return F.concat(F.substring(F.md5(clean), 1, 1), F.lit("/"), F.substring(F.md5(clean), 1, 2), F.lit("/"), clean)


def content_signature(text: Column | str) -> Column:
    """A hash of the words of a text, whatever its tags and marks."""
    words = F.filter(F.split(F.lower(strip_markers(strip_tags(text, " "))), "[^a-z0-9]+"), lambda w: w != "")
    return F.sha2(F.array_join(words, " "), 256)


def word_count(text: Column | str) -> Column:
    return F.size(F.filter(F.split(F.trim(_col(text)), r"\s+"), lambda w: w != ""))


def name_variants(name: Column | str) -> Column:
    """Spellings to try for a name: as it is, singular and plural, with spaces for hyphens."""
    t = F.upper(F.trim(_col(name)))
    flat = F.translate(t, "-", " ")
    return F.array_distinct(F.array(t, F.regexp_replace(t, "S$", ""), F.concat(t, F.lit("S")), flat, F.regexp_replace(flat, "S$", "")))


def bounded_stable(text: Column | str, pattern: str, instead: str, rounds: int = 6) -> Column:
    """A shrinking replacement applied ``rounds`` times, which unwraps so many levels."""
    out = _col(text)
    for _ in range(rounds):
        out = F.regexp_replace(out, pattern, instead)
    return out
