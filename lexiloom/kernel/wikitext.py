"""Recognising marked-up source: balanced constructs, a tree of elements, and its marker stream.

One recursive descent over the text; every function is pure.  What is not balanced stays text, so
that nothing disappears without being seen.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

#: Tags whose inside is not markup.
OPAQUE = ("nowiki", "math", "pre", "score", "chem")
_OPEN = re.compile(r"\{\{|\{\||\[\[|<!--|<(?P<tag>[A-Za-z][A-Za-z0-9]*)\b(?P<attrs>[^<>]*?)(?P<self>/?)>")


@dataclass
class Element:
    """A node of the tree: its label, its name and arguments, and what it holds."""

    label: str
    name: str = ""
    args: list[str] = field(default_factory=list)
    named: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # texts and elements
    raw: str = ""


def construct_end(text: str, start: int) -> int:
    """The end of the construct that opens at ``start``, or -1 if it does not close."""
    m = _OPEN.match(text, start)
    if not m:
        return -1
    opener = m.group()
    if opener == "<!--":
        end = text.find("-->", start)
        return end + 3 if end >= 0 else -1
    if text.startswith("{{{", start) and not text.startswith("{{{{", start):
        return _balanced(text, start + 3, "}}}")
    if opener == "{{":
        return _balanced(text, m.end(), "}}")
    if opener == "{|":
        return _balanced(text, m.end(), "|}")
    if opener == "[[":
        return _balanced(text, m.end(), "]]")
    if m.group("self") or m.group("tag").lower() in ("br", "hr", "img"):
        return m.end()
    name = m.group("tag")
    closer = re.compile(rf"</{name}\s*>", re.I)
    if name.lower() in OPAQUE:
        c = closer.search(text, m.end())
        return c.end() if c else -1
    at = m.end()
    while at < len(text):
        c = closer.match(text, at)
        if c:
            return c.end()
        if _OPEN.match(text, at):
            inner = construct_end(text, at)
            at = inner if inner > 0 else at + 1
        else:
            at += 1
    return -1


def _balanced(text: str, at: int, closer: str) -> int:
    while at < len(text):
        if text.startswith(closer, at):
            return at + len(closer)
        if _OPEN.match(text, at):
            inner = construct_end(text, at)
            at = inner if inner > 0 else at + 1
        else:
            at += 1
    return -1


def split_top(text: str, sign: str = "|") -> list[str]:
    """The parts of a text between signs that no construct encloses."""
    parts, start, at = [], 0, 0
    while at < len(text):
        if text[at] == sign:
            parts.append(text[start:at])
            start = at = at + 1
            continue
        inner = construct_end(text, at) if text[at] in "{[<" else -1
        at = inner if inner > 0 else at + 1
    return [*parts, text[start:]]


def constructs(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the outermost constructs, in order."""
    at = 0
    while (m := _OPEN.search(text, at)) is not None:
        end = construct_end(text, m.start())
        if end > 0:
            yield m.start(), end
            at = end
        else:
            at = m.start() + 1


def parameters(inner: str) -> tuple[str, list[str], dict[str, str]]:
    """A template's name, its positional and its named parameters."""
    name, *rest = split_top(inner)
    args, named = [], {}
    for part in rest:
        key, equals, value = part.partition("=")
        if equals and re.fullmatch(r"\s*[\w -]+\s*", key):
            named[key.strip()] = value.strip()
        else:
            args.append(part)
    return name.strip(), args, named


def quotes(line: str) -> str:
    """Runs of apostrophes on one line as italic and bold marks.

    Runs of four count as an apostrophe and bold, longer than five as apostrophes and five.  With an
    odd number of both, one bold run becomes an apostrophe and italic: the first after a single-letter
    word, else after a longer word, else after a space.
    """
    pieces = re.split(r"('{2,})", line)
    for i in range(1, len(pieces), 2):
        n = len(pieces[i])
        if n == 4 or n > 5:
            extra = 1 if n == 4 else n - 5
            pieces[i - 1] += "'" * extra
            pieces[i] = "'" * (n - extra)
    bold = sum(len(p) in (3, 5) for p in pieces[1::2])
    italic = sum(len(p) in (2, 5) for p in pieces[1::2])
    if bold % 2 and italic % 2:
        best: dict[str, int] = {}
        for i in range(1, len(pieces), 2):
            if len(pieces[i]) == 3:
                before = pieces[i - 1]
                kind = "space" if before.endswith(" ") else "single" if before[-2:-1] == " " else "word"
                best.setdefault(kind, i)
        at = best.get("single", best.get("word", best.get("space")))
        if at is not None:
            pieces[at - 1] += "'"
            pieces[at] = "''"
    out, state = [pieces[0]], ""  # the marks that are open, the outer first
    for i in range(1, len(pieces), 2):
        both = state[::-1] if len(state) == 2 else "BI" if state == "B" else "IB"
        for mark in {2: "I", 3: "B", 5: both}[len(pieces[i])]:
            if mark in state:
                for inner in reversed(state[state.index(mark) :]):
                    out.append(f"«/{inner}»")
                again = state[state.index(mark) + 1 :]
                state = state[: state.index(mark)] + again
                out += [f"«{m}»" for m in again]
            else:
                out.append(f"«{mark}»")
                state += mark
        out.append(pieces[i + 1])
    return "".join(out) + "".join(f"«/{m}»" for m in reversed(state))


#: What templates and tags are, by their names in lower case.
TEMPLATES = {
    "c": "CENTER", "center": "CENTER", "rh": "RUNNING_HEADER", "running header": "RUNNING_HEADER", "sc": "SMALL_CAPS", "small-caps": "SMALL_CAPS", "larger": "STYLE", "smaller": "STYLE",
    "x-larger": "STYLE", "hws": "SPLIT_WORD", "hwe": "SPLIT_WORD", "anchor": "ANCHOR", "anchor+": "ANCHOR", "dhr": "SPACER", "rule": "RULE", "nop": "STRIP", "-": "STRIP", "lang": "LANG",
    "fraction": "FRACTION", "frac": "FRACTION", "sfrac": "FRACTION", "ref": "REF", "shoulder": "SHOULDER", "sidenote": "SHOULDER", "hanging indent": "HANGING_INDENT", "ppoem": "PPOEM",
    "author link": "AUTHOR_LINK", "article link": "ARTICLE_LINK", "link": "ARTICLE_LINK", "image": "IMAGE", "img float": "IMAGE", "coords": "COORDINATES", "missing image": "MISSING", "missing math": "MISSING",
    "dropinitial": "DROP_INITIAL", "drop initial": "DROP_INITIAL", "di": "DROP_INITIAL", "nobr": "STYLE", "sup": "SUP", "sub": "SUB", "ts": "TABLE_STYLE",
    "cite": "CITE", "lb": "LB", "lb-": "LB", "lps": "SPLIT_WORD", "lpe": "SPLIT_WORD", "main other": "MAIN_OTHER", "fs": "PARAM", "font size": "PARAM", "size": "PARAM", "ti": "PARAM", "margin-left": "PARAM",
    "csc": "CENTER", "hi": "HANGING_INDENT", "outdent": "HANGING_INDENT", "brace2": "BRACE", "dual line": "DUAL_LINE", "equation": "MATH_EQUATION", "mathform1": "MATH_EQUATION", "ne": "MATH_EQUATION",
    "hieroglyph": "HIEROGLYPH", "reflist": "REFS", "smallrefs": "REFS", "figure": "IMAGE", "fi": "IMAGE", "fis": "IMAGE", "raw image": "IMAGE", "css image crop": "IMAGE", "plain image with caption": "IMAGE",
    "tooltip": "CONTENT_EXTRACT", "abbr": "CONTENT_EXTRACT", "sic": "CONTENT_EXTRACT", "definition": "CONTENT_EXTRACT", "nodent": "CONTENT_EXTRACT", "greek": "LANG", "polytonic": "LANG", "hebrew": "LANG", "arabic": "LANG",
    "em": "SPACER", "gap": "SPACER", "clear": "SPACER", "ditto": "SPACER", "bar": "SPACER", "shy": "SPACER", "=": "SPACER", "(": "SPACER", ")": "SPACER", "!": "SPACER", "'": "SPACER", "*": "SPACER", "...": "SPACER",
    "section": "ANCHOR", "over": "FRACTION", "mfrac": "FRACTION", "familytree": "CHART2", "chart2": "CHART2", "tree chart": "CHART2", "left": "STYLE", "right": "STYLE", "fine block": "STYLE", "uc": "UPPER_CASE",
}
#: What leaves without content show.
LEAVES = {"em": " ", "gap": " ", "clear": "", "ditto": "″", "bar": "—", "shy": "\xad", "=": "=", "(": "{{", ")": "}}", "!": "|", "'": "'", "*": "*", "...": "…"}
TAGS = {
    "b": "BOLD", "i": "ITALIC", "em": "ITALIC", "strong": "BOLD", "ref": "REF", "br": "BR", "math": "MATH", "score": "SCORE", "nowiki": "NOWIKI", "noinclude": "NOINCLUDE", "includeonly": "INCLUDEONLY",
    "section": "SECTION", "poem": "PPOEM", "blockquote": "BLOCKQUOTE", "center": "CENTER", "sup": "SUP", "sub": "SUB", "ol": "OLIST", "ul": "ULIST", "li": "ITEM", "table": "HTML_TABLE", "tr": "ROW", "td": "TD",
    "th": "TH", "caption": "CAPTION", "span": "SPAN", "div": "DIV", "del": "DELETED", "ins": "INSERTED", "pre": "NOWIKI", "chem": "MATH", "hr": "RULE", "p": "DIV", "small": "STYLE", "big": "STYLE", "tt": "STYLE",
    "references": "REFS", "pagequality": "PAGEQUALITY", "bdo": "HTML_STYLE",
}


def parse(text: str) -> Element:
    """The tree of a marked-up text.  Lines that begin with colons or number signs are paragraphs set in and list items."""
    return Element("BODY", children=_blocks(text), raw=text)


_SET_IN = re.compile(r"^(:+|#+)[^\S\n]*", re.M)


def _blocks(text: str) -> list:
    if not _SET_IN.search(text):
        return _children(text)
    out: list = []
    plain_lines: list[str] = []
    items: list[Element] = []

    def close() -> None:
        if items:
            out.append(Element("LIST", children=list(items), raw="\n".join(i.raw for i in items)))
            items.clear()
        if plain_lines:
            out.extend(_children("\n".join(plain_lines) + "\n"))
            plain_lines.clear()

    for line in _top_lines(text):
        m = _SET_IN.match(line)
        if m and m.group(1)[0] == "#":
            if plain_lines:
                close()
            items.append(Element("LIST_ITEM", children=_children(line[m.end() :]), raw=line))
        elif m:
            close()
            out.append(Element("INDENT", str(len(m.group(1))), children=_children(line[m.end() :]), raw=line))
        else:
            if items:
                close()
            plain_lines.append(line)
    if plain_lines and not items:
        out.extend(_children("\n".join(plain_lines)))
    else:
        close()
    return out


def _top_lines(text: str) -> list[str]:
    """Lines, none of which ends inside a construct."""
    inside = list(constructs(text))
    cuts, k = [], 0
    for m in re.finditer("\n", text):
        while k < len(inside) and inside[k][1] <= m.start():
            k += 1
        if k == len(inside) or m.start() < inside[k][0]:
            cuts.append(m.start())
    return [text[a:b] for a, b in zip([0, *[c + 1 for c in cuts]], [*cuts, len(text)])]


_HALF = re.compile(r"^\{\{\s*([^{}|/]*?)\s*/\s*(s|e|start|end)\s*(?:\|[^{}]*)?\}\}$", re.I)
#: Charts that are shown as an image.
CHARTS = ("chart2", "familytree", "tree chart")


def _paired(nodes: list) -> list:
    """The nodes, where a ``NAME/s`` and the ``NAME/e`` that closes it hold what stands between them; a half alone is a mark."""
    out: list = []
    open_: list[tuple[str, int]] = []
    for node in nodes:
        m = _HALF.match(node.raw) if isinstance(node, Element) and node.raw.startswith("{{") else None
        if not m:
            out.append(node)
            continue
        name = m.group(1).lower()
        if m.group(2).lower() in ("s", "start"):
            node.label, node.children = "WRAP_OPEN", []
            open_.append((name, len(out)))
            out.append(node)
            continue
        at = next((i for n, i in reversed(open_) if n == name), None)
        if at is None:
            node.label, node.children = "WRAP_CLOSE", []
            out.append(node)
            continue
        inner = out[at + 1 :]
        raw = out[at].raw + "".join(n if isinstance(n, str) else n.raw for n in inner) + node.raw
        out[at:] = [Element("GENEALOGY" if name in CHARTS else "PAIRED_WRAPPER", name, out[at].args, out[at].named, inner, raw)]
        open_ = [(n, i) for n, i in open_ if i < at]
    return out


def _children(text: str) -> list:
    out, at = [], 0
    for start, end in constructs(text):
        if start > at:
            out.append(text[at:start])
        out.append(_element(text[start:end]))
        at = end
    if at < len(text):
        out.append(text[at:])
    return _paired(out)


def _template_label(key: str, args: list[str]) -> str:
    """The label of a template by its name, or by what the name ends in."""
    if key in TEMPLATES:
        return TEMPLATES[key]
    for ending, label in (("intra-article link", "INTRA_ARTICLE_LINK"), ("article link", "ARTICLE_LINK"), ("lkpl", "TARGET_FIRST_LINK"), ("link", "ARTICLE_LINK"), ("shoulder heading", "SHOULDER"), ("margin note", "SHOULDER")):
        if key.endswith(ending):
            return label
    for ending, label in (("heading", "PAGE_HEADING"), ("footer", "CONTRIBUTOR_FOOTER"), ("coordinates", "COORDINATES"), ("frac", "FRACTION")):
        if key.endswith(ending):
            return label
    if key.startswith(("toc row", "dtpl", "dotted toc")):
        return "TOC_ROW"
    if re.search(r"\\over(?![a-z])", key):
        return "FRACTION"
    return "DOUBLE_BRACE_LEAK"


def _element(raw: str) -> Element:
    if raw.startswith("<!--"):
        return Element("COMMENT", raw=raw)
    if raw.startswith("{{{") and raw.endswith("}}}"):
        name, *default = split_top(raw[3:-3])
        return Element("PARAM_DEFAULT", name.strip(), default[:1], {}, _children(default[0]) if default else [], raw)
    if raw.startswith("{{"):
        name, args, named = parameters(raw[2:-2])
        key = re.sub(r"\s+", " ", name.lower().replace("_", " "))
        label = _template_label(key, args)
        slots = args if label != "DOUBLE_BRACE_LEAK" else []
        return Element(label, name, args, named, [Element("SLOT", str(i), children=_children(a)) for i, a in enumerate(slots)], raw)
    if raw.startswith("{|"):
        return _wiki_table(raw)
    if raw.startswith("[["):
        target, *rest = split_top(raw[2:-2])
        kind = target.strip().lower()
        label = "IMAGE" if kind.startswith(("file:", "image:")) else "AUTHOR_LINK" if kind.startswith("author:") else "FRAGMENT_LINK" if kind.startswith("#") else "WIKILINK"
        shown = rest[-1] if rest else target
        return Element(label, target.strip(), rest, {}, _children(shown), raw)
    m = _OPEN.match(raw)
    name = m.group("tag").lower()
    attrs = dict(re.findall(r"([\w-]+)\s*=\s*[\"']?([^\"'>]*)[\"']?", m.group("attrs") or ""))
    label = TAGS.get(name, "TAG_LEAK")
    if name == "span" and "title" in attrs:
        label = "SPAN_TITLE"
    elif name in ("span", "div", "p", "ins") and ("style" in attrs or "align" in attrs):
        label = "HTML_STYLE"
    if m.end() == len(raw):
        return Element("REF_SELF" if name == "ref" else label, name, [], attrs, [], raw)
    inner = raw[m.end() : raw.rfind("</")]
    return Element(label, name, [], attrs, [inner] if name in OPAQUE else _children(inner), raw)


_CELL_ATTRS = re.compile(r"^\s*(?:[\w-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s|]+)\s*|\{\{[Tt]s\|[^{}]*\}\}\s*)+$")


def _wiki_table(raw: str) -> Element:
    """A table in bar syntax: caption, rows and cells with their attributes."""
    lines, table = raw[2:-2].split("\n"), Element("TABLE", raw=raw)
    table.named = dict(re.findall(r"([\w-]+)\s*=\s*\"?([^\"\s]*)\"?", lines[0]))
    row: Element | None = None
    cell: list | None = None
    texts: list[tuple[Element, list[str]]] = []

    def add(line: str, label: str) -> None:
        nonlocal row, cell
        if row is None:
            row = Element("ROW")
            table.children.append(row)
        for part in re.split(r"\|\||!!", line) if label == "TH" else line.split("||"):
            pieces = split_top(part)
            attrs = pieces[0] if len(pieces) > 1 and _CELL_ATTRS.match(pieces[0]) else ""
            body = "|".join(pieces[1:]) if attrs else part
            node = Element(label, named=dict(re.findall(r"([\w-]+)\s*=\s*\"?([^\"\s|]*)\"?", attrs)))
            row.children.append(node)
            cell = [body]
            texts.append((node, cell))

    for line in _join_open(lines[1:]):
        if line.startswith("|+"):
            node = Element("CAPTION", children=_children(line[2:].strip()))
            table.children.append(node)
        elif line.startswith("|-"):
            row = Element("ROW", named=dict(re.findall(r"([\w-]+)\s*=\s*\"?([^\"\s]*)\"?", line[2:])))
            table.children.append(row)
        elif line.startswith(("|", "!")):
            add(line[1:], "TH" if line[0] == "!" else "TD")
        elif cell is not None:
            cell.append(line)
    for node, parts in texts:
        node.children = _children("\n".join(parts).strip())
    table.children = [c for c in table.children if c.label != "ROW" or c.children]
    return table


def _join_open(lines: list[str]) -> list[str]:
    """Lines, where one that opens a construct goes on until it closes."""
    out, held = [], ""
    for line in lines:
        held = f"{held}\n{line}" if held else line
        if held.count("{{") <= held.count("}}") and held.count("{|") <= held.count("|}"):
            out.append(held)
            held = ""
    return [*out, held] if held else out


def rows(tree: Element, path: str = "", depth: int = 0) -> Iterator[tuple[str, int, int, str, str]]:
    """The tree flattened: ``(path, depth, order, label, raw)``."""
    order = 0
    for child in tree.children:
        if isinstance(child, Element):
            order += 1
            here = f"{path}/{order}"
            if child.label != "SLOT":
                yield here, depth, order, child.label, child.raw[:200]
            yield from rows(child, here, depth + 1)


def plain(tree: Element) -> str:
    """The text of a tree without any markup."""
    return "".join(c if isinstance(c, str) else "" if c.label in ("COMMENT", "NOINCLUDE", "REF", "DELETED") else plain(c) for c in tree.children)


# --- producing the marker stream ---------------------------------------------------------------


class Producer:
    """Folds a tree into its marker stream; notes are numbered and named ones are merged in document order."""

    def __init__(self) -> None:
        self.notes: dict[str, list[str]] = {}

    def body(self, text: str) -> str:
        tree = parse(strip_hidden(text))
        self._collect(tree)
        out = self.join(tree)
        out = "\n".join(quotes(line) for line in out.split("\n"))
        return stamp_windows(re.sub(r"[ \t]+\n", "\n", re.sub(r"\n[ \t]*\n\s*", "«P»", out)).strip())

    def _collect(self, tree: Element) -> None:
        for child in tree.children:
            if isinstance(child, Element):
                name = child.named.get("name") or child.named.get("follow")
                if child.label == "REF" and name:
                    self.notes.setdefault(name, []).append(self.join(child).strip())
                self._collect(child)

    def join(self, tree: Element) -> str:
        return "".join(c if isinstance(c, str) else self.element(c) for c in tree.children)

    def slot(self, node: Element, i: int) -> str:
        return self.join(node.children[i]) if i < len(node.children) else ""

    def element(self, node: Element) -> str:
        make = getattr(self, f"_{node.label.lower()}", None)
        return make(node) if make else node.raw

    def _wrap(self, mark: str, inside: str) -> str:
        return f"«{mark}»{inside}«/{mark.split('[')[0]}»" if inside.strip() else inside

    def _inner(self, node: Element) -> str:
        slots = [c for c in node.children if isinstance(c, Element) and c.label == "SLOT"]
        return self.join(slots[-1]) if slots else self.join(node)

    def _comment(self, node): return ""
    def _noinclude(self, node): return ""
    def _running_header(self, node): return ""
    def _page_heading(self, node): return ""
    def _strip(self, node): return ""
    def _deleted(self, node): return ""
    def _table_style(self, node): return ""
    def _section(self, node): return ""
    def _includeonly(self, node): return self.join(node)
    def _inserted(self, node): return self.join(node)
    def _style(self, node): return self._inner(node)
    def _lang(self, node): return self._inner(node)
    def _span(self, node): return self.join(node)
    def _drop_initial(self, node): return self.slot(node, 0)
    def _center(self, node): return self._wrap("CTR", self._inner(node))
    def _small_caps(self, node): return self._wrap("SC", self._inner(node))
    def _bold(self, node): return self._wrap("B", self.join(node))
    def _italic(self, node): return self._wrap("I", self.join(node))
    def _sup(self, node): return self._wrap("SPAN[style:vertical-align:super]", self._inner(node))
    def _sub(self, node): return self._wrap("SPAN[style:vertical-align:sub]", self._inner(node))
    def _blockquote(self, node): return self._wrap("DIV[quote]", self.join(node))
    def _hanging_indent(self, node): return self._wrap("DIV[hanging]", self._inner(node))
    def _div(self, node): return self._wrap("DIV", self.join(node))
    def _br(self, node): return "«BR»"
    def _spacer(self, node): return LEAVES.get(node.name.lower(), "«DHR»")
    def _rule(self, node): return "«BAR»"
    def _shoulder(self, node): return self._wrap("SH", self._inner(node))
    def _nowiki(self, node): return html.unescape(self.join(node)) if node.name != "nowiki" else self.join(node)
    def _math(self, node): return f"«MATH:{self.join(node).strip()}«/MATH»"
    def _score(self, node): return f"«MATH[score]:{self.join(node).strip()}«/MATH»"
    def _coordinates(self, node): return coordinates(node.args)
    def _missing(self, node): return f"[{node.name}]"
    def _anchor(self, node): return f"«ANCHOR:{slug(self.slot(node, 0))}|{self.slot(node, len(node.children) - 1)}»"
    def _olist(self, node): return self._wrap(f"OL[type:{node.named['type']}]" if node.named.get("type") else "OL", self.join(node).strip())
    def _ulist(self, node): return self._wrap("UL", self.join(node).strip())
    def _item(self, node): return f"«LI»{self.join(node).strip()}«/LI»"
    def _ppoem(self, node): return "«BR»".join(self._inner(node).strip().split("\n"))

    def _split_word(self, node: Element) -> str:
        """The two halves of a word that a page end divides: the second carries the whole."""
        return self.slot(node, 1) if node.name.lower() in ("hwe", "lpe") else ""

    def _cite(self, node): return self._wrap("I", self.slot(node, 0))
    def _lb(self, node): return f"{self.slot(node, 0)} lb".strip()
    def _upper_case(self, node): return self._inner(node).upper()
    def _main_other(self, node): return self.slot(node, 0)
    def _param_default(self, node): return self.join(node) if node.args else node.raw
    def _param(self, node): return self._wrap(f"SPAN[style:{self._style_of(node)}]", self._inner(node))
    def _html_style(self, node): return self._wrap(f"{'DIV' if node.name in ('div', 'p') else 'SPAN'}[style:{node.named.get('style') or 'text-align:' + node.named.get('align', '')}]", self.join(node))
    def _span_title(self, node): return self.join(node)
    def _content_extract(self, node): return self.slot(node, len(node.children) - 1 if node.name.lower() == "definition" else 0)
    def _brace(self, node): return "}" if self.slot(node, 1).strip().lower().startswith("r") else "{"
    def _dual_line(self, node): return "«BR»".join(self.slot(node, i).strip() for i in range(2))
    def _toc_row(self, node): return " … ".join(s for i in range(len(node.children)) if (s := self.slot(node, i).strip()))
    def _hieroglyph(self, node): return f"«HIERO:{self.slot(node, 0).strip()}«/HIERO»"
    def _refs(self, node): return ""
    def _pagequality(self, node): return ""
    def _contributor_footer(self, node): return self._wrap("SIGN", " ".join(s for i in range(len(node.children)) if (s := self.slot(node, i).strip())))
    def _wrap_open(self, node): return f"«{self._half(node)}»"
    def _wrap_close(self, node): return f"«/{self._half(node)}»"
    def _chart2(self, node): return "{{IMG:" + slug(node.name) + ".jpg|Genealogical table}}"
    def _list_item(self, node): return f"«LI»{self.join(node).strip()}«/LI»"
    def _list(self, node): return "«OL»" + self.join(node) + "«/OL»"
    def _indent(self, node): return self._wrap(f"DIV[indent:{node.name}]", self.join(node).strip()) + "\n"

    @staticmethod
    def _half(node: Element) -> str:
        """The mark of a wrapper by its name."""
        name = _HALF.match(node.raw).group(1).lower()
        return {"c": "CTR", "center": "CTR", "center block": "CTR", "smaller block": "SMALL", "fine block": "SMALL"}.get(name, "DIV")

    @staticmethod
    def _style_of(node: Element) -> str:
        value = node.args[0].strip() if len(node.args) > 1 else ""
        return {"ti": "text-indent", "margin-left": "margin-left"}.get(node.name.lower(), "font-size") + f":{value or 'inherit'}"

    def _paired_wrapper(self, node: Element) -> str:
        name = {"c": "CTR", "center": "CTR", "center block": "CTR", "smaller block": "SMALL", "fine block": "SMALL"}.get(node.name, "DIV")
        return self._wrap(name, self.join(node).strip())

    def _genealogy(self, node: Element) -> str:
        """A chart as its image, with the notes that it holds."""
        notes: list[str] = []

        def walk(tree: Element) -> None:
            for child in tree.children:
                if isinstance(child, Element):
                    if child.label in ("REF", "REF_SELF"):
                        notes.append(self.element(child))
                    else:
                        walk(child)

        walk(node)
        return "{{IMG:" + slug(node.name) + ".jpg|Genealogical table}}" + "".join(notes)

    def _math_equation(self, node: Element) -> str:
        """A displayed equation: its number, which is the slot in brackets or of figures alone, and the rest."""
        slots = [self.slot(node, i).strip() for i in range(len(node.children))]
        number = next((i for i, s in enumerate(slots) if re.fullmatch(r"\(?\w{1,6}\)?[.,;]?", s)), None)
        body = " ".join(s for i, s in enumerate(slots) if s and i != number)
        label = equation_label(slots[number]) if number is not None else ""
        return f"«EQN[{label}]:{body}«/EQN»" if label else f"«EQN:{body}«/EQN»"

    def _target_first_link(self, node: Element) -> str:
        target = node.args[0].strip() if node.args else ""
        return f"«LN:{target}|{self.slot(node, 1) or target}«/LN»" if target else node.raw

    def _fragment_link(self, node: Element) -> str:
        return f"«LN:{node.name}|{self.join(node).lstrip('#')}«/LN»"

    def _intra_article_link(self, node: Element) -> str:
        target = node.args[0].strip() if node.args else ""
        return f"«LN:#{target}|{self.slot(node, len(node.children) - 1) or target}«/LN»" if target else node.raw

    def _fraction(self, node: Element) -> str:
        if not node.children and (m := re.match(r"^(.*?)\s*\\over(?![A-Za-z])\s*(.*)$", node.name)):
            return f"{m.group(1).strip()}/{m.group(2).strip()}"
        parts = [self.join(c) for c in node.children]
        return f"{parts[0]} {parts[1]}/{parts[2]}" if len(parts) > 2 else "/".join(parts)

    def _ref_self(self, node: Element) -> str:
        return self._note(self.notes.get(node.named.get("name", ""), [""]), node.named.get("name", ""))

    def _ref(self, node: Element) -> str:
        if node.named.get("follow"):
            return ""
        name = node.named.get("name", "")
        return self._note(self.notes[name] if name else [self._inner(node).strip()], name)

    def _note(self, texts: list[str], name: str) -> str:
        text = " ".join(t for t in texts if t)
        return f"«FN[{name}]:{text}«/FN»" if name else f"«FN:{text}«/FN»"

    def _wikilink(self, node: Element) -> str:
        target = subpage(node.name)
        return f"«LN:{target}|{self.join(node)}«/LN»"

    def _article_link(self, node: Element) -> str:
        target = node.args[0].strip() if node.args else ""
        return f"«LN:{target}|{self.slot(node, len(node.children) - 1) or target}«/LN»" if target else node.raw

    def _author_link(self, node: Element) -> str:
        target = node.name.split(":", 1)[-1] if ":" in node.name else (node.args[0] if node.args else "")
        return f"«AL:{target.strip()}|{self.join(node) if node.raw.startswith('[[') else self.slot(node, len(node.children) - 1) or target}«/AL»"

    def _image(self, node: Element) -> str:
        parts = [p.strip() for p in node.args]
        name = (node.name.split(":", 1)[-1] if ":" in node.name else node.named.get("file", parts[0] if parts else "")).strip().replace(" ", "_")
        align = next((p for p in parts if p in ("left", "right", "center")), node.named.get("align", ""))
        width = next((re.sub(r"\D", "", p) for p in parts if re.fullmatch(r"\d+(?:x\d+)?px", p)), re.sub(r"\D", "", node.named.get("width", "")))
        caption = node.named.get("cap", "") or next((p for p in reversed(parts) if p and p not in ("left", "right", "center", "thumb", "frameless", "frame") and not re.fullmatch(r"\d+(?:x\d+)?px", p) and "=" not in p and p != name), "")
        meta = "".join(f"|{k}={v}" for k, v in (("align", align), ("width", width)) if v)
        return f"{{{{IMG:{name}{meta}{'|' + caption if caption else ''}}}}}"

    def _table(self, node: Element) -> str:
        rows_ = [c for c in node.children if isinstance(c, Element) and c.label == "ROW"]
        width = max((sum(int(c.named.get("colspan") or 1) for c in r.children if isinstance(c, Element)) for r in rows_), default=0)
        out = [f"«TABLE[cols:{width}]»"]
        for child in node.children:
            if isinstance(child, Element) and child.label == "CAPTION":
                out.append(f"«CAPTION»{self.join(child)}«/CAPTION»")
            elif isinstance(child, Element) and child.label == "ROW":
                cells = "".join(self._cell(c) for c in child.children if isinstance(c, Element))
                out.append(f"«TR»{cells}«/TR»")
        return "".join(out) + "«/TABLE»"

    _html_table = _table

    def _cell(self, node: Element) -> str:
        spans = "|".join(f"{k}:{v}" for k, v in node.named.items() if k in ("rowspan", "colspan") and v.isdigit())
        return f"«{node.label}{'[' + spans + ']' if spans else ''}»{self.join(node).strip()}«/{node.label}»"

    def _row(self, node: Element) -> str:
        return "«TR»" + "".join(self._cell(c) for c in node.children if isinstance(c, Element)) + "«/TR»"


def equation_label(text: str) -> str:
    """The number of an equation without marks, brackets and the point of its sentence."""
    text = re.sub(r"«[^«»]*»", "", text).strip()
    m = re.match(r"[(\[]\s*([^()\[\]]*?)\s*[)\]]", text)
    return m.group(1) if m else text.rstrip(".,;:").strip()


def without_templates(text: str, names: tuple[str, ...], ending: str) -> str:
    """The text without the templates of these names, or of a name with this ending."""
    out, at = [], 0
    for start, end in constructs(text):
        if text.startswith("{{", start):
            name = re.split(r"[|}/]", text[start + 2 : end], maxsplit=1)[0].strip().lower()
            if name in names or name.endswith(ending):
                out.append(text[at:start])
                at = end
        elif text.startswith("<", start) and not text.startswith("<!--", start) and (m := _OPEN.match(text, start)) and m.end() < end:
            closer = text.rfind("</", start, end)
            out.append(text[at : m.end()] + without_templates(text[m.end() : closer], names, ending))
            at = closer
    return "".join(out) + text[at:]


def slug(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", text.strip().lower()).strip("-")


def subpage(target: str) -> str:
    """The title that a path of a page names: its last part before any section; marks are kept whole."""
    path, sign, section = target.partition("#")
    last = re.split(r"/(?![A-Z]+»)", path.strip("/"))[-1]
    return f"{last}{sign}{section}".strip()


def coordinates(args: list[str]) -> str:
    marks = ("°", "′", "″", "")
    return "".join(a.strip() + m for a, m in zip(args, marks[: max(0, len(args) - 1)] + ("",))) if args else ""


def strip_hidden(text: str) -> str:
    """Comments (a run of line ends around one counts as its longer side), and marks of inclusion."""
    text = re.sub(r"(\n*)<!--.*?-->(\n*)", lambda m: max(m.group(1), m.group(2), key=len), text, flags=re.S)
    return re.sub(r"</?includeonly>", "", text)


def decode_entities(text: str) -> str:
    """Entities as characters, but for those that would look like a tag or a bar."""
    return re.sub(r"&(?:#\d+|#x[0-9a-fA-F]+|\w+);", lambda m: m.group() if m.group()[1:-1] in ("lt", "gt", "vert", "#60", "#62", "#124") else html.unescape(m.group()), text)


_QV = re.compile(r"([A-Z][\w'’-]*(?: [A-Z][\w'’-]*){0,5}) \((?:«I»)?q\.v\.(?:«/I»)?\)")
_SEE = re.compile(r"\((see also|see) ([A-Z][^()«»]{2,80})\)")


def stamp_windows(text: str) -> str:
    """References that are only said: what precedes *(q.v.)* and what *(see ...)* names become link windows."""
    text = _QV.sub(lambda m: f"«LN[w]:{m.group(1)}|{m.group(1)}«/LN» (q.v.)", text)
    return _SEE.sub(lambda m: f"({m.group(1)} «LN[{m.group(1).replace(' ', '_')}]:{m.group(2)}|{m.group(2)}«/LN»)", text)


def produce(text: str | None) -> str | None:
    """The marker stream of a marked-up text; None for None."""
    return None if text is None else Producer().body(text)


def title(text: str) -> tuple[str, str]:
    """The leading bold title of a marker stream and what follows it."""
    m = re.match(r"\s*((?:«B».*?«/B»[\s,]*)+)", text, re.S)
    if not m:
        return "", text
    return re.sub(r"«/?[A-Z]+»", "", m.group(1)).strip(" ,"), text[m.end() :].lstrip(" ,")
