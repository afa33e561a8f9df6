"""The recogniser and the emitters as Arrow functions on columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import functions as F

from pyspark.sql import types as T

from lexiloom.functions.types import BOOLEAN, STRING, array, rows, struct
from lexiloom.kernel import markers, wikitext


def _text(f: Callable[[str], str | None]):
    @F.pandas_udf(STRING)
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in series:
            yield s.map(f, na_action="ignore")

    return run


produce = _text(wikitext.produce)
decode_entities = _text(wikitext.decode_entities)
markdown = _text(markers.markdown)
html = _text(markers.to_html)
plain_source = _text(lambda t: wikitext.plain(wikitext.parse(t)))


def _rows(f: Callable[[str], list], kind: T.DataType):
    @F.pandas_udf(kind)
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in series:
            yield pd.Series([None if t is None else f(t) for t in s], dtype=object)

    return run


def _named(names: str, f: Callable[[str], list]) -> Callable[[str], list]:
    keys = names.split()
    return lambda t: [dict(zip(keys, row)) for row in f(t)]


elements = _rows(_named("path depth ord label raw", lambda t: list(wikitext.rows(wikitext.parse(t)))), rows("path:string,depth:int,ord:int,label:string,raw:string"))
links = _rows(_named("type target display surface", lambda t: list(markers.links(t))), rows("type:string,target:string,display:string,surface:string"))
sections = _rows(_named("kind level name", markers.sections), rows("kind:string,level:int,name:string"))
notes = _rows(_named("number name text uses", markers.notes), rows("number:int,name:string,text:string,uses:int"))
spans = _rows(_named("name start end", markers.spans), rows("name:string,start:int,end:int"))
dangling = _rows(markers.dangling, array("string"))
cells = _rows(
    _named("row col text", lambda t: [(i, j, c) for n in markers.parse(t) if isinstance(n, markers.Mark) and n.name == "TABLE" for i, line in enumerate(markers.Markdown().grid(n)) for j, c in enumerate(line)]),
    rows("row:int,col:int,text:string"),
)


@F.pandas_udf(STRING)
def tei(body: pd.Series, title: pd.Series, volume: pd.Series, pages: pd.Series) -> pd.Series:
    return pd.Series([markers.tei(b, t or "", None if pd.isna(v) else int(v), p or "") for b, t, v, p in zip(body, title, volume, pages)], dtype=object)


@F.pandas_udf(BOOLEAN)
def well_formed(documents: pd.Series) -> pd.Series:
    from xml.etree import ElementTree

    def check(text: str | None) -> bool | None:
        if text is None:
            return None
        try:
            ElementTree.fromstring(text)
            return True
        except ElementTree.ParseError:
            return False

    return documents.map(check)


@F.pandas_udf(struct("title:string, body:string"))
def carve_title(texts: pd.Series) -> pd.DataFrame:
    """The leading bold title of a stream and the rest."""
    parts = [wikitext.title(t or "") for t in texts]
    return pd.DataFrame(parts, columns=["title", "body"])
