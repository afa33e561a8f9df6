"""What a finished text must not hold any more: seven checks on three formats, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("html", "markdown", "text")
#: Names of tags that a text may have meant.
TAGS = "a abbr b big blockquote br chem cite code div em hr i includeonly ins li mark ol p poem pre q ref s score small span strike strong sub sup table tbody td th thead tr u ul var".split()
#: What each check looks for, in the text as it is, without its mathematics, or without its tags too; and the formats it can be made on.
CHECKS = (
    ("marker", r"«/?[A-Z][A-Za-z0-9_]*[\[:»]", "raw", FORMATS),
    ("template", r"\{\{|\}\}", "plain", FORMATS),
    ("wikilink", r"\[\[|\]\]", "plain", FORMATS),
    ("attr", r"\b(?:style|align|valign|colspan|rowspan|bgcolor|scope|cellpadding|cellspacing|width|height)=", "bare", FORMATS),
    ("tag", r"(?i)&lt;/?(?:" + "|".join(TAGS) + r")\b[^&<>]{0,200}?&gt;", "plain", ("html",)),
    ("indent", r"(?:</?(?:p|div|li|ul|ol|h[1-6]|blockquote)\b[^>]*>)\s*:+[^\s:<]", "plain", ("html",)),
    ("sentinel", "[\x01\x02\x03]", "raw", FORMATS),
)
_MATH = {"html": r'(?s)<span class="math">.*?</span>', "markdown": r"(?s)\$\$.*?\$\$|\$[^$\n]*\$", "text": None}


def find_leaks(text: Column, fmt: str) -> Column:
    """The names of the checks that a text of this format does not pass, sorted; null for a null text."""
    plain = F.regexp_replace(text, _MATH[fmt], "") if _MATH[fmt] else text
    views = {"raw": text, "plain": plain, "bare": plain if fmt == "text" else F.regexp_replace(plain, "<[^>]*>", " ")}
    found = [F.when(views[where].rlike(pattern), F.lit(name)) for name, pattern, where, formats in sorted(CHECKS) if fmt in formats]
    return F.when(text.isNotNull(), F.array_compact(F.array(*found)))
