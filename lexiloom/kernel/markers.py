"""Marker streams as trees, and their emitters: Markdown, HTML and TEI."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from lexiloom.kernel.wikitext import slug
from lexiloom.operators.sequence import spread_cells

TOKEN = re.compile(r"«(?P<close>/)?(?P<name>[A-Z][A-Za-z0-9_]*)(?:\[(?P<attrs>[^«»]*)\])?(?:(?P<colon>:)(?P<point>[^«»]*»)?|(?P<end>»))|\{\{IMG:(?P<img>[^{}]*)\}\}")
#: Markers that hold nothing.
EMPTY = ("P", "BR", "BAR", "DHR", "DHRI")
SPLIT = ("TITLE", "FN", "LN", "AL", "XL", "MATH", "EQN")


@dataclass
class Mark:
    """A marker with its attributes, its payload and what it encloses."""

    name: str
    attrs: str = ""
    payload: str = ""
    children: list = field(default_factory=list)
    raw: str = ""


def parse(text: str) -> list:
    """The stream as texts and marks; an opener without its close, or a stray close, stays text."""
    return _parse(text)


def _closes(text: str, at: int, name: str) -> tuple[int, int] | None:
    """The close of a marker whose opener ends at ``at``, by depth."""
    depth = 1
    for m in TOKEN.finditer(text, at):
        if m.group("name") != name or (m.group("point") and not m.group("close")):
            continue
        depth += -1 if m.group("close") else 1
        if depth == 0:
            return m.start(), m.end()
    return None


def _parse(text: str) -> list:
    out: list = []
    at = 0
    while (m := TOKEN.search(text, at)) is not None:
        if m.start() > at:
            out.append(text[at : m.start()])
        at = m.end()
        if m.group("img") is not None:
            out.append(Mark("IMG", payload=m.group("img"), raw=m.group()))
        elif m.group("close"):
            out.append(m.group())
        elif m.group("point") is not None:
            out.append(Mark(m.group("name"), m.group("attrs") or "", m.group("point")[:-1], raw=m.group()))
        elif m.group("name") in EMPTY:
            out.append(Mark(m.group("name"), m.group("attrs") or "", raw=m.group()))
        else:
            close = _closes(text, m.end(), m.group("name"))
            if close is None:
                out.append(m.group())
                continue
            inner = text[m.end() : close[0]]
            mark = Mark(m.group("name"), m.group("attrs") or "", raw=text[m.start() : close[1]])
            if mark.name in ("LN", "AL", "XL"):
                mark.payload, _, shown = inner.partition("|")
                mark.children = _parse(shown if _ else inner)
            elif mark.name in ("MATH", "EQN"):
                mark.payload = inner
            else:
                mark.children = _parse(inner)
            out.append(mark)
            at = close[1]
    if at < len(text):
        out.append(text[at:])
    return out


def links(text: str) -> Iterator[tuple[str, str, str, str]]:
    """``(type, target, display, surface)`` of the link marks, in order, nested ones included."""

    def walk(nodes: list) -> Iterator[tuple[str, str, str, str]]:
        for n in nodes:
            if isinstance(n, Mark):
                if n.name in ("LN", "AL"):
                    target, _, shown = n.payload.partition("|")
                    kind = "author" if n.name == "AL" else n.attrs if n.attrs in ("see", "see_also") else "link"
                    yield kind, target.strip(), "".join(plain(n.children)) or shown or target, n.raw
                yield from walk(n.children)

    return walk(parse(text))


def plain(nodes: list) -> str:
    return "".join(n if isinstance(n, str) else "" if n.name in ("FN", "MATH", "EQN", "IMG", "ANCHOR") else " " if n.name in EMPTY else plain(n.children) or n.payload.split("|")[-1] for n in nodes)


def notes(text: str) -> list[tuple[int, str, str, int]]:
    """``(number, name, text, uses)`` of the notes of a stream by their first place; repetitions of a name share a number, and the first of them that says something is the note."""
    found: dict[object, list] = {}

    def walk(nodes: list) -> None:
        for n in nodes:
            if isinstance(n, Mark):
                if n.name == "FN":
                    inner = n.raw[n.raw.index(":") + 1 : -len("«/FN»")]
                    note = found.setdefault(n.attrs or len(found), [len(found) + 1, n.attrs, "", 0])
                    note[2], note[3] = note[2] or inner, note[3] + 1
                walk(n.children)

    walk(parse(text))
    return [tuple(n) for n in found.values()]


def sections(text: str) -> list[tuple[str, int, str]]:
    """``(kind, level, name)`` of section marks, shoulder heads and anchors in order."""
    kinds = {"SEC": ("sec", 1), "SH": ("sh", 2), "ANCHOR": ("anchor", 3)}
    out: list[tuple[str, int, str]] = []

    def walk(nodes: list) -> None:
        for n in nodes:
            if isinstance(n, Mark):
                if n.name in kinds:
                    out.append((*kinds[n.name], (n.payload.split("|")[-1] or plain(n.children)).strip()))
                walk(n.children)

    walk(parse(text))
    return out


def spans(text: str) -> list[tuple[str, int, int]]:
    """``(name, start, end)`` of marker openers with the next close of their name, nested or not."""
    out, open_ = [], []
    for m in TOKEN.finditer(text):
        if m.group("img") is not None or m.group("point") is not None and not m.group("close") or m.group("name") in EMPTY:
            continue
        if m.group("close"):
            at = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == m.group("name")), None)
            if at is not None:
                out.append((open_[at][0], open_[at][1], m.end()))
                open_.pop(at)
        else:
            open_.append((m.group("name"), m.start()))
    return sorted(out, key=lambda s: (s[1], -s[2]))


def crossing(text: str) -> list[tuple[str, str]]:
    """Pairs of spans that cross: one begins inside the other and ends after it."""
    found = spans(text)
    return [(a[0], b[0]) for i, a in enumerate(found) for b in found[i + 1 :] if a[1] < b[1] < a[2] < b[2]]


def dangling(text: str) -> list[str]:
    """Marks without their other half."""
    return [n for n in _strings(parse(text)) if TOKEN.search(n)]


def _strings(nodes: list) -> Iterator[str]:
    for n in nodes:
        if isinstance(n, str):
            yield n
        else:
            yield from _strings(n.children)


class Emitter:
    """Walks a stream; subclasses say how each mark is written.  Unknown marks show what they enclose."""

    def __init__(self) -> None:
        self.notes: list[str] = []
        self.named: dict[str, int] = {}
        self.ids: dict[str, int] = {}

    def text(self, s: str) -> str:
        return s

    def walk(self, nodes: list) -> str:
        return "".join(self.text(n) if isinstance(n, str) else self.mark(n) for n in nodes)

    def mark(self, n: Mark) -> str:
        make = getattr(self, n.name.lower(), None)
        return make(n) if make else self.walk(n.children)

    def note(self, n: Mark) -> int:
        """The number of a note; repetitions of a name share it."""
        if n.attrs and n.attrs in self.named:
            return self.named[n.attrs]
        place = len(self.notes)
        self.notes.append("")
        if n.attrs:
            self.named[n.attrs] = place + 1
        self.notes[place] = self.walk(n.children).strip()
        return place + 1

    def unique(self, name: str) -> str:
        """An id, with ``-2``, ``-3`` ... for its repetitions in the document."""
        self.ids[name] = self.ids.get(name, 0) + 1
        return name if self.ids[name] == 1 else f"{name}-{self.ids[name]}"

    def shown(self, n: Mark) -> tuple[str, str]:
        target, _, rest = n.payload.partition("|")
        return target, self.walk(n.children) if n.children else self.text(rest or target)

    def image(self, n: Mark) -> tuple[str, dict[str, str], str]:
        name, *rest = n.payload.split("|")
        meta = dict(p.split("=", 1) for p in rest if re.fullmatch(r"(?:align|width|height)=\w+", p))
        return name, meta, "|".join(p for p in rest if not re.fullmatch(r"(?:align|width|height)=\w+", p))

    def grid(self, n: Mark) -> list[list[str]]:
        rows = []
        for r in n.children:
            if isinstance(r, Mark) and r.name == "TR":
                rows.append([(self.walk(c.children).strip(), *(int((re.search(rf"{k}:(\d+)", c.attrs) or [0, 1])[1]) for k in ("rowspan", "colspan"))) for c in r.children if isinstance(c, Mark) and c.name in ("TD", "TH")])
        return spread_cells(rows)


class Markdown(Emitter):
    def document(self, text: str) -> str:
        body = re.sub(r"\n{3,}", "\n\n", self.walk(parse(text))).strip()
        notes = "\n".join(f"[^{i}]: {t}" for i, t in enumerate(self.notes, 1))
        return f"{body}\n\n{notes}" if notes else body

    def b(self, n): return f"**{self.walk(n.children)}**"
    def i(self, n): return f"*{self.walk(n.children)}*"
    def p(self, n): return "\n\n"
    def br(self, n): return "  \n"
    def bar(self, n): return "\n\n---\n\n"
    dhr = p
    def title(self, n): return f"# {self.walk(n.children)}\n\n"
    def sec(self, n): return f"\n\n## {n.payload.split('|')[-1]}\n\n"
    def sh(self, n): return f"\n\n### {self.walk(n.children)}\n\n"
    def anchor(self, n): return ""
    def fn(self, n): return f"[^{self.note(n)}]"
    def math(self, n): return f"${n.payload}$"
    eqn = math

    def ln(self, n):
        target, shown = self.shown(n)
        return f"[{shown}]({slug(target)})" if target else shown

    def al(self, n): return self.shown(n)[1]

    def xl(self, n):
        target, shown = self.shown(n)
        return f"[{shown}]({target})"

    def img(self, n):
        name, _, caption = self.image(n)
        return f"![{caption}]({name})"

    def ul(self, n): return self._list(n, lambda i: "- ")
    def ol(self, n): return self._list(n, lambda i: f"{i}. ")

    def _list(self, n, sign):
        items = [self.walk(c.children).strip().replace("\n", "\n   ") for c in n.children if isinstance(c, Mark) and c.name == "LI"]
        return "\n" + "\n".join(sign(i) + t for i, t in enumerate(items, 1)) + "\n"

    def table(self, n):
        grid = self.grid(n)
        width = max(map(len, grid), default=0)
        cell = lambda t: re.sub(r"\s*\n\s*", " ", t).replace("|", "\\|")
        lines = ["| " + " | ".join(map(cell, row + [""] * (width - len(row)))) + " |" for row in grid]
        if lines:
            lines.insert(1, "|" + " --- |" * width)
        caption = next((self.walk(c.children) for c in n.children if isinstance(c, Mark) and c.name == "CAPTION"), "")
        return "\n\n" + (f"{caption}\n\n" if caption else "") + "\n".join(lines) + "\n\n"


class Html(Emitter):
    def document(self, text: str) -> str:
        parts = [p for p in re.split(r"\s*«P»\s*", text) if p.strip()]
        body = "".join(f"<p>{self.walk(parse(p))}</p>" for p in parts)
        notes = "".join(f'<li id="fn{i}">{t}</li>' for i, t in enumerate(self.notes, 1))
        return body + (f'<ol class="notes">{notes}</ol>' if notes else "")

    def text(self, s): return html.escape(s, quote=False)
    def b(self, n): return f"<b>{self.walk(n.children)}</b>"
    def i(self, n): return f"<i>{self.walk(n.children)}</i>"
    def sc(self, n): return f'<span class="sc">{self.walk(n.children)}</span>'
    def ctr(self, n): return f'<span class="ctr">{self.walk(n.children)}</span>'
    def br(self, n): return "<br/>"
    def bar(self, n): return "<hr/>"
    def p(self, n): return "</p><p>"
    def sec(self, n): return f'<a id="{self.unique(slug(n.payload.split("|")[0]))}"></a>'
    anchor = sec
    def sh(self, n): return f'<b class="sh" id="{self.unique(slug(plain(n.children)))}">{self.walk(n.children)}</b>'
    def fn(self, n): return f'<sup><a href="#fn{(k := self.note(n))}">{k}</a></sup>'
    def math(self, n): return f'<span class="math">{html.escape(n.payload)}</span>'
    eqn = math
    def title(self, n): return f"<span class=\"title\">{self.walk(n.children)}</span>"

    def ln(self, n):
        target, shown = self.shown(n)
        return f'<a href="{slug(target)}">{shown}</a>' if target else shown

    def al(self, n): return f'<span class="author">{self.shown(n)[1]}</span>'

    def img(self, n):
        name, meta, caption = self.image(n)
        size = "".join(f' {k}="{html.escape(v)}"' for k, v in meta.items() if k != "align")
        return f'<img src="{html.escape(name)}"{size} alt="{html.escape(caption)}"/>'

    def ul(self, n): return f"<ul>{self.walk([c for c in n.children if isinstance(c, Mark)])}</ul>"
    def ol(self, n): return f"<ol>{self.walk([c for c in n.children if isinstance(c, Mark)])}</ol>"
    def li(self, n): return f"<li>{self.walk(n.children)}</li>"
    def table(self, n): return f"<table>{self.walk([c for c in n.children if isinstance(c, Mark)])}</table>"
    def tr(self, n): return f"<tr>{self.walk([c for c in n.children if isinstance(c, Mark)])}</tr>"
    def caption(self, n): return f"<caption>{self.walk(n.children)}</caption>"
    def td(self, n): return self._cell(n, "td")
    def th(self, n): return self._cell(n, "th")

    def _cell(self, n, tag):
        spans_ = "".join(f' {k}="{v}"' for k, v in re.findall(r"(rowspan|colspan):(\d+)", n.attrs))
        return f"<{tag}{spans_}>{self.walk(n.children)}</{tag}>"


class Tei(Emitter):
    """TEI P5; spans that cross are left as text by the parser, so what comes out is well-formed."""

    def document(self, text: str, heading: str = "", volume: int | None = None, pages: str = "") -> str:
        parts = [p for p in re.split(r"\s*«P»\s*", text) if p.strip()]
        body = "".join(f"<p>{self.walk(parse(p))}</p>" for p in parts) or "<p/>"
        head = f"<fileDesc><titleStmt><title>{self.text(heading)}</title></titleStmt><publicationStmt><p/></publicationStmt><sourceDesc><bibl><biblScope unit=\"volume\">{volume if volume is not None else ''}</biblScope><biblScope unit=\"page\">{self.text(pages)}</biblScope></bibl></sourceDesc></fileDesc>"
        return f'<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader>{head}</teiHeader><text><body>{body}</body></text></TEI>'

    def text(self, s): return html.escape(re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "", s), quote=False)
    def b(self, n): return f'<hi rend="bold">{self.walk(n.children)}</hi>'
    def i(self, n): return f'<hi rend="italic">{self.walk(n.children)}</hi>'
    def sc(self, n): return f'<hi rend="small-caps">{self.walk(n.children)}</hi>'
    def ctr(self, n): return f'<hi rend="center">{self.walk(n.children)}</hi>'
    def br(self, n): return "<lb/>"
    def p(self, n): return "<lb/>"
    def fn(self, n): return f'<note n="{self.note(n)}">{self.walk(n.children)}</note>'
    def math(self, n): return f"<formula notation=\"tex\">{self.text(n.payload)}</formula>"
    eqn = math
    def sec(self, n): return f'<anchor xml:id="{self.unique("s-" + slug(n.payload.split("|")[0]))}"/>'
    anchor = sec

    def ln(self, n):
        target, shown = self.shown(n)
        return f'<ref target="#{slug(target)}">{shown}</ref>'

    def al(self, n): return f"<name>{self.shown(n)[1]}</name>"

    def img(self, n):
        name, _, caption = self.image(n)
        return f'<figure><graphic url="{html.escape(name)}"/><figDesc>{self.text(caption)}</figDesc></figure>'

    def ul(self, n): return f"<list>{self.walk([c for c in n.children if isinstance(c, Mark)])}</list>"
    ol = ul
    def li(self, n): return f"<item>{self.walk(n.children)}</item>"
    def table(self, n): return f"<table>{self.walk([c for c in n.children if isinstance(c, Mark)])}</table>"
    def tr(self, n): return f"<row>{self.walk([c for c in n.children if isinstance(c, Mark)])}</row>"
    def td(self, n): return f"<cell>{self.walk(n.children)}</cell>"
    def caption(self, n): return f"<head>{self.walk(n.children)}</head>"

    def th(self, n): return f'<cell role="label">{self.walk(n.children)}</cell>'


def markdown(text: str | None) -> str | None:
    return None if text is None else Markdown().document(text)


def to_html(text: str | None) -> str | None:
    return None if text is None else Html().document(text)


def tei(text: str | None, heading: str = "", volume: int | None = None, pages: str = "") -> str | None:
    return None if text is None else Tei().document(text, heading, volume, pages)
