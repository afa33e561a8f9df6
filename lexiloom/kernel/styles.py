"""Codes of table styles as the rules of style sheets that they stand for."""

from __future__ import annotations

import re

#: Codes that no rule below makes.
NAMED = {
    "ar": "text-align:right", "ac": "text-align:center", "al": "text-align:left", "aj": "text-align:justify", "all": "text-align-last:left", "alc": "text-align-last:center", "alr": "text-align-last:right",
    "bgt": "background-color:transparent;color:inherit", "bc": "border-collapse:collapse", "bn": "border:none", "db": "display:block", "dc": "display:contents", "df": "display:flex", "di": "display:inline",
    "dib": "display:inline-block", "dn": "display:none", "dt": "display:table", "mc": "margin:0 auto 0 auto", "ma": "margin-right:auto; margin-left:auto", "ffs": "font-family:serif", "ffn": "font-family:sans-serif",
    "asc": "font-variant:all-small-caps", "sc": "font-variant:small-caps", "fvn": "font-variant:normal", "uc": "text-transform:uppercase", "lc": "text-transform:lowercase", "cap": "text-transform:capitalize",
    "fll": "float:left", "flr": "float:right", "fsn": "font-style:normal", "fsi": "font-style:italic", "fwn": "font-weight:normal", "fwb": "font-weight:bold", "fwbfsi": "font-weight:bold;font-style:italic",
    "ofh": "overflow:hidden", "abs": "position:absolute", "rel": "position:relative", "ltr": "direction:ltr", "rtl": "direction:rtl", "tds": "text-decoration:line-through", "tdu": "text-decoration:underline",
    "vtt": "vertical-align:text-top", "vtb": "vertical-align:text-bottom", "vtp": "vertical-align:top", "vbs": "vertical-align:baseline", "vbm": "vertical-align:bottom", "vmi": "vertical-align:middle",
    "wnw": "white-space:nowrap", "itp": "padding-left:2em; text-indent:-1em", "it": "padding-left:2em; text-indent:-2em", "it1": "padding-left:1em; text-indent:-1em",
}
#: Other names of codes.
ALIASES = {
    "right": "ar", "center": "ac", "centre": "ac", "left": "al", "justify": "aj", "transparent": "bgt", "collapse": "bc", "border": "ba", "smaller": "fs083", "sm": "fs083", "x-smaller": "fs069", "xs": "fs069",
    "xx-smaller": "fs058", "fine": "fs092", "larger": "fs120", "lg": "fs120", "x-larger": "fs144", "xl": "fs144", "xx-larger": "fs182", "small caps": "sc", "uppercase": "uc", "lowercase": "lc", "italic": "fsi", "bb4xd": "bbd",
}
_SIDES = {"a": "", "l": "-left", "r": "-right", "t": "-top", "b": "-bottom"}
#: Shares that are no whole per cent.
_PARTS = {"17": "calc(100% / 6)", "33": "calc(100% / 3)", "67": "calc(100% / 1.5)", "83": "calc(100% / 1.2)"}


def css(code: str) -> str | None:
    """The rule of one code; None if it is unknown."""
    code = code.strip().lower()
    code = ALIASES.get(code, code)
    if code in NAMED:
        return NAMED[code]
    if m := re.fullmatch(r"b([altrb])(\d?)([.d]?)", code):
        kind = {"": "solid", ".": "dotted", "d": "double"}[m.group(3)]
        return f"border{_SIDES[m.group(1)]}:{m.group(2) or (4 if kind == 'double' else 1)}px {kind}"
    if m := re.fullmatch(r"b([tblr])t(1?)", code):
        return f"border{_SIDES[m.group(1)]}:{m.group(2) or 0}px solid transparent"
    if m := re.fullmatch(r"([hw])(\d+|max|min)", code):
        n = m.group(2)
        return f"{'height' if m.group(1) == 'h' else 'width'}:{_PARTS.get(n) or (n + '-content' if n in ('max', 'min') else '0' if n == '0' else n + '%')}"
    if m := re.fullmatch(r"m([atrbl])(\d+)", code):
        return f"margin{_SIDES[m.group(1)]}:{m.group(2)}px"
    if m := re.fullmatch(r"(lh|fs)(\d+)", code):
        return f"{'line-height' if m.group(1) == 'lh' else 'font-size'}:{int(m.group(2))}%"
    if m := re.fullmatch(r"p(lr|tb|[lrtb]?)(\d?(?:\.5)?)", code):
        n = ("0" if m.group(2).startswith(".") else "") + m.group(2)
        if not n:
            return None
        both = m.group(1) in ("lr", "tb")
        size = n if n == "0" and not both else f"{n}em"
        return "; ".join(f"padding{_SIDES[s]}:{size}" for s in (m.group(1) or "a"))
    if m := re.fullmatch(r"it(\d?)p(\d?(?:\.5)?)", code):
        hang = int(m.group(1) or 2)
        return f"padding-left:{hang + float(m.group(2) or 0):g}em; text-indent:-{hang}em"
    return None


def rules(codes: str | None) -> str | None:
    """The rules of codes between bars, without those that are unknown."""
    return None if codes is None else ";".join(r for c in codes.split("|") if (r := css(c)))
