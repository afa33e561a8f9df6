"""Likeness of strings that the JVM has no function for."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F

from lexiloom.functions.types import DOUBLE, array


@F.pandas_udf(DOUBLE)
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the characters in matching blocks by the length of both strings; null with a null."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


#: Signs of names, the most common first.
_COMMON = {c: i for i, c in enumerate(" .eanrioltshdmcugbfwykpvjzxq")}


def _rare_letters(text: str) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for c in text:
        n = seen[c] = seen.get(c, 0) + 1
        out.append((-_COMMON.get(c, 99) - 8 * (n - 1), f"{c}{n}"))
    return [x for _, x in sorted(out)]


@F.pandas_udf(array("string"))
def rare_letters(texts: pd.Series) -> pd.Series:
    """The letters of a text, each with the number of its occurrence, in one order for all texts, rare ones first."""
    return pd.Series([_rare_letters(t) for t in texts], dtype=object)
