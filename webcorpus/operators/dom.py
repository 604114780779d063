"""Element-tree walk of one page: main text, panes by id, hrefs.

A small helper for `operators.extract`; it sees one page at a time.
"""

from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser

from webcorpus.functions.markup import BOILERPLATE

# What marks an element as no content.
_ID_CLASS_WORDS = ("lang", "translat", "goog", "cookie")
_CLASSES = ("header", "footer", "sidebar")
_SILENT = ("script", "style", "template", "rt", "rp")
# Elements without an end tag.
_VOID = (
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr",
    "image", "img", "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid",
    "param", "source", "spacer", "track", "wbr",
)


class _Element:
    __slots__ = ("name", "dropped", "hidden", "silent", "roles", "id", "start")

    def __init__(self, name, attrs, parent, start):
        ident, classes = attrs.get("id") or "", attrs.get("class") or ""
        tokens = classes.split()
        self.name = name
        self.id = ident
        self.start = start
        self.hidden = name == "noscript" or (parent is not None and parent.hidden)
        self.silent = name in _SILENT
        self.dropped = (
            (parent is not None and parent.dropped)
            or name in BOILERPLATE
            or any(word in ident or word in classes for word in _ID_CLASS_WORDS)
            or any(marker in tokens for marker in _CLASSES)
        )
        self.roles = []
        if not (self.dropped or self.hidden):
            if name in ("main", "body", "article"):
                self.roles.append(name)
            if ident == "main-content":
                self.roles.append("main-content")
            if name == "div" and "content" in tokens:
                self.roles.append("content")


class _Walker(HTMLParser):
    """Text nodes in document order, and the span of nodes each region covers.

    A span is (opened, closed, first node, end node); the first two count the
    tags, so that order and nesting are exact for empty elements too.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = []
        self.open_names = Counter()
        self.tags = 0
        self.nodes = []
        self.pending = []
        self.roles = {}
        self.ids = {}
        self.hrefs = {}

    def handle_starttag(self, name, attrs):
        self._flush()
        self.tags += 1
        values = dict(attrs)
        parent = self.open[-1] if self.open else None
        element = _Element(name, values, parent, (self.tags, len(self.nodes)))
        if name == "a" and values.get("href") and not element.hidden:
            self.hrefs[values["href"]] = None
        self.open.append(element)
        self.open_names[name] += 1
        if name in _VOID:
            self._close_last()

    def handle_startendtag(self, name, attrs):
        self.handle_starttag(name, attrs)
        if name not in _VOID:
            self.handle_endtag(name)

    def handle_endtag(self, name):
        if self.open_names[name]:
            self._flush()
            while self._close_last() != name:
                pass

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self._flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def finish(self):
        self.close()
        self._flush()
        while self.open:
            self._close_last()

    def _flush(self):
        text = "".join(self.pending).strip()
        self.pending.clear()
        top = self.open[-1] if self.open else None
        if text and not (top and (top.hidden or top.silent)):
            self.nodes.append((text, top is None or not top.dropped))

    def _close_last(self):
        element = self.open.pop()
        self.open_names[element.name] -= 1
        self.tags += 1
        opened, first = element.start
        span = (opened, self.tags, first, len(self.nodes))
        for role in element.roles:
            self.roles.setdefault(role, []).append(span)
        if element.id and not element.hidden:
            self.ids.setdefault(element.id, []).append(span)
        return element.name

    def text(self, span, kept_only=True):
        nodes = self.nodes[span[2] : span[3]]
        return "\n".join(text for text, kept in nodes if kept or not kept_only)

    def first(self, role, scope):
        """The element of a role that opens first inside `scope`."""
        inside = (
            s for s in self.roles.get(role, ()) if scope[0] <= s[0] and s[1] <= scope[1]
        )
        return min(inside, default=None)


def walk(html: str, article_first: bool = True, all_panes: bool = False):
    """(main text, hrefs, [(id, text)]) of a page.

    Panes are the elements that a `#id` link of the page points to, or all
    elements with an id. They come from the whole page, boilerplate included;
    of several elements with one id the first counts.
    """
    walker = _Walker()
    walker.feed(html)
    walker.finish()
    whole = (0, walker.tags + 1, 0, len(walker.nodes))
    article = walker.first("article", whole) if article_first else None
    main = None
    for role in ("main", "main-content", "content"):
        main = main or walker.first(role, article or whole)
    main = main or article or walker.first("body", whole) or whole
    linked = {h.strip()[1:] for h in walker.hrefs if h.strip().startswith("#")}
    panes = [
        (ident, walker.text(min(spans), kept_only=False))
        for ident, spans in walker.ids.items()
        if all_panes or ident in linked
    ]
    return walker.text(main), list(walker.hrefs), [p for p in panes if p[1]]
