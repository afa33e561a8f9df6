"""Full-text search: an inverted index and ranked queries on it."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions import text as X
from lexiloom.operators.ordered import previous


def terms(df: DataFrame, key: str, text: str) -> DataFrame:
    """Columns ``key, term``: the distinct folded words of each text."""
    words = F.split(F.lower(X.fold_accents(text)), "[^a-z0-9]+")
    return df.select(key, F.explode(F.array_distinct(F.filter(words, lambda w: w != ""))).alias("term"))


def most_documents(n: int, least: int = 200, share: float = 0.27) -> float:
    """Documents that a term may be in before it is too common to be looked up."""
    return max(least, share * n)


def index(df: DataFrame, key: str, text: str, chunk: int = 100_000) -> DataFrame:
    """Columns ``term, part, n, docs``: sorted ids of the documents of each term.

    A term's list is cut into parts of ``chunk`` by the hash of the id, so that no task has to hold
    the list of a word that is everywhere.
    """
    found = terms(df, key, text)
    total = max(1, df.count())
    parts = max(1, -(-total // chunk))
    placed = found.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    return placed.groupBy("term", "part").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(key)).alias("docs"))


def frequent(found: DataFrame, total: int) -> DataFrame:
    """Columns ``term, n, ignored``: in how many documents a term is, and whether it is too common."""
    counted = found.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("ignored", F.col("n") > F.lit(most_documents(total)))


def all_terms(found: DataFrame, key: str, wanted: Sequence[str]) -> DataFrame:
    """Documents that have all the terms."""
    return found.where(F.col("term").isin(*wanted)).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(set(wanted))).select(key)


def ranked(df: DataFrame, key: str, title: str, body: str, question: str, limit: int | None = None) -> DataFrame:
    """Columns ``key, title, tier, matches``: what has the question in its title or body, best first.

    Tiers: the title is the question, begins with it as a word, begins with it, has it as a word, has
    it, only the body has it; then more matches in the body, then the alphabet.
    """
    q = F.lower(X.fold_accents(F.lit(question)))
    t, b = F.lower(X.fold_accents(title)), F.lower(X.fold_accents(body))
    word = F.concat(F.lit(" "), F.regexp_replace(t, "[^a-z0-9]+", " "), F.lit(" "))
    tier = (
        F.when(t == q, 0).when(word.startswith(F.concat(F.lit(" "), q, F.lit(" "))), 1).when(t.startswith(q), 2)
        .when(word.contains(F.concat(F.lit(" "), q, F.lit(" "))), 3).when(t.contains(q), 4).otherwise(5)
    )
    hits = df.where(t.contains(q) | b.contains(q)).select(key, title, tier.alias("tier"), X.occurrences(b, q).alias("matches"))
    best = hits.orderBy("tier", F.desc("matches"), title, key)
    return best.limit(limit) if limit else best


def deltas(found: DataFrame, key: str) -> DataFrame:
    """Columns ``term, key, gap``: how many ids lie between a posting and the one before it.

    The postings of a word that is everywhere are spread over blocks.
    """
    rows = previous(found.select("term", key), ["term"], [key], key, "__before")
    return rows.select("term", key, F.coalesce(F.col(key) - F.col("__before") - 1, F.col(key)).alias("gap"))


#: The 64 digits of postings.
DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"


def varint(n: int) -> str:
    """A number in groups of five bits, the lowest first; all but the last have the sixth bit set."""
    out = ""
    while True:
        n, low = divmod(n, 32)
        out += DIGITS[low + 32 * bool(n)]
        if not n:
            return out


def unvarint(text: str) -> list[int]:
    """The numbers that ``varint`` wrote one after another."""
    out, n, shift = [], 0, 0
    for c in text:
        digit = DIGITS.index(c)
        n |= (digit & 31) << shift
        shift += 5
        if digit < 32:
            out.append(n)
            n, shift = 0, 0
    return out


@dataclass
class Question:
    """A question taken apart: its words, and what its filters ask for."""

    words: list[str]
    volume: int | None = None
    by: str | None = None


def parse_question(text: str) -> Question:
    """``vol:4``, ``by:smith`` and ``by:"john smith"`` are filters, the rest are words; a filter of no use is a word."""
    words, volume, by = [], None, None
    for name, quoted, plain in re.findall(r'(?:\b(vol|by):)?(?:"([^"]*)"|(\S+))', text):
        value = quoted or plain
        if name == "vol" and value.isdigit():
            volume = int(value)
        elif name == "by" and value.strip():
            by = value.strip()
        else:
            words += re.findall(r"\w+", f"{name}:{value}" if name else value)
    return Question([w.lower() for w in words], volume, by)


def ask(articles: DataFrame, authors: DataFrame, question: str, key: str = "id") -> DataFrame:
    """The ``key`` of the articles that a question finds, plates excluded.

    ``articles`` has ``key, volume, article_type, title, body``; every word must be in title or body.
    ``authors`` has ``key, full_name``; *by* asks for its words in one author's name.
    """
    asked = parse_question(question)
    rows = articles.where("article_type IS NULL OR article_type <> 'plate'")
    if asked.volume is not None:
        rows = rows.where(F.col("volume") == asked.volume)
    text = F.lower(X.fold_accents(F.concat_ws(" ", "title", "body")))
    for word in asked.words:
        rows = rows.where(text.contains(F.lower(X.fold_accents(F.lit(word)))))
    if asked.by:
        name = F.concat(F.lit(" "), F.regexp_replace(F.lower(X.fold_accents("full_name")), "[^a-z]+", " "), F.lit(" "))
        wrote = authors
        for word in re.findall("[a-z]+", asked.by.lower()):
            wrote = wrote.where(name.contains(f" {word} "))
        rows = rows.join(wrote.select(key), key, "left_semi")
    return rows.select(key)
