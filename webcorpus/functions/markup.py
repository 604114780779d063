"""Markup to text and links by regular expressions, inside the JVM.

The fast route for pages whose boilerplate elements do not nest in elements of
the same name and carry no id or class that matters. `operators.extract` has
the exact route that walks the element tree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcorpus.functions.text import let, strip

# Elements that are never content.
BOILERPLATE = ("header", "footer", "nav", "aside", "form", "script", "style")
_HIDDEN = r"(?is)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\z)"
_REMOVED = r"(?is)<(header|footer|nav|aside|form)\b[^>]*>.*?</\1\s*>"
# Regions that may hold the content, best first.
_REGIONS = (
    r"(?is)<article\b[^>]*>(.*?)</article\s*>",
    r"(?is)<main\b[^>]*>(.*?)</main\s*>",
    r"(?is)<body\b[^>]*>(.*?)(?:</body\s*>|\z)",
)
_BOUNDARY = "\u0001"

# Entities this route decodes; the ampersand comes last.
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&#39;": "'",
    "&#34;": '"',
    "&nbsp;": "\u00a0",
    "&copy;": "©",
    "&reg;": "®",
    "&middot;": "·",
    "&ndash;": "–",
    "&mdash;": "—",
    "&hellip;": "…",
    "&lsquo;": "‘",
    "&rsquo;": "’",
    "&ldquo;": "“",
    "&rdquo;": "”",
    "&euro;": "€",
    "&amp;": "&",
}
_UNCLOSED_ENTITY = "&(lt|gt|quot|nbsp|copy|reg|middot|amp)(?!;)"

_ANCHOR = (
    r"""(?is)<a(?:\s[^>]*?)?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
)


def decode_entities(text: Column) -> Column:
    """Decode the entities above; text with none but `&amp;` takes one replacement."""

    def decoded(raw: Column) -> Column:
        whole = F.regexp_replace(raw, _UNCLOSED_ENTITY, "&$1;")
        for entity, char in ENTITIES.items():
            whole = F.replace(whole, F.lit(entity), F.lit(char))
        ampersands = F.replace(raw, F.lit("&amp;"), F.lit("&"))
        return F.when(raw.rlike("&(?!amp;)"), whole).otherwise(ampersands)

    return let(text, decoded)


def _region(html: Column) -> Column:
    """The first region that has something in it, else the whole page."""

    def inside(page: Column, pattern: str) -> Column:
        return let(F.regexp_extract(page, pattern, 1), lambda r: F.when(r != "", r))

    return let(html, lambda page: F.coalesce(*[inside(page, p) for p in _REGIONS], page))


def visible_text(html: Column) -> Column:
    """Text nodes of the content region, trimmed, one per line."""
    region = _region(F.regexp_replace(html, _HIDDEN, ""))
    bare = F.regexp_replace(F.regexp_replace(region, _REMOVED, ""), "<[^>]*>", _BOUNDARY)
    nodes = F.transform(F.split(decode_entities(bare), _BOUNDARY), strip)
    return F.array_join(F.filter(nodes, lambda node: node != ""), "\n")


def hrefs(html: Column) -> Column:
    """Distinct non-empty `href` values of a page's anchors."""
    raw = F.regexp_extract_all(F.regexp_replace(html, _HIDDEN, ""), F.lit(_ANCHOR), F.lit(1))
    plain = F.transform(
        raw,
        lambda h: decode_entities(F.regexp_replace(h, "^[\"']|[\"']$", "")),
    )
    return F.array_distinct(F.filter(plain, lambda h: h != ""))

