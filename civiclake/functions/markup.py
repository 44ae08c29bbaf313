"""Pages to tokens: tags with attributes, texts and raw texts of HTML as browsers cut it, for Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from xml.parsers import expat

#: Elements whose content is text up to their own end tag; in those of ESCAPED character references count.
RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes"}
ESCAPED = {"title", "textarea"}
#: Elements that a reader doesn't see.
HIDDEN = {"script", "style", "noscript"}
_NAME = re.compile(r"[^\s/>]*")
#: An attribute: its name, which may begin with an equals sign, and its value in quotes of either kind or bare.
_ATTRIBUTE = re.compile(r"""[\s/]*(=?[^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|((?!["'])[^\s>]*)))?""")
_BLANK = " \t\n\r\f"


def _attributes(html: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes from ``at`` on and the place behind the tag's end, -1 where the page ends before."""
    found: dict[str, str] = {}
    size = len(html)
    while True:
        while at < size and html[at] in _BLANK + "/":
            at += 1
        if at >= size:
            return found, -1
        if html[at] == ">":
            return found, at + 1
        m = _ATTRIBUTE.match(html, at)
        name, *values = m.groups()
        if m.end() == at:
            return found, -1
        at = m.end()
        # An equals sign that is left has an open quote behind it: the page ends in the value.
        if at < size and html[at] == "=" or (at < size and html[at] in _BLANK and html[at:].lstrip(_BLANK).startswith("=")):
            return found, -1
        value = next((v for v in values if v is not None), "")
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)


def tokens(html: str) -> Iterator[tuple[str, str, dict[str, str] | None]]:
    """("start", name, attributes), ("end", name, None), ("text", text, None) and ("raw", text, None) in their order.

    Names are in lower case; character references count in texts and attribute values, not in raw texts. A tag that the
    page ends within is left out, as are comments, declarations and instructions; a "<" that opens nothing is text.
    """
    at, size, text = 0, len(html), []

    def flush():
        out = "".join(text)
        text.clear()
        return ("text", unescape(out) if "&" in out else out, None)

    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            text.append(html[at:])
            break
        if lt > at:
            text.append(html[at:lt])
        nxt = html[lt + 1 : lt + 2]
        if nxt.isascii() and nxt.isalpha():
            name = _NAME.match(html, lt + 1).group().lower()
            attributes, at = _attributes(html, lt + 1 + len(name))
            if text:
                yield flush()
            if at < 0:
                return
            yield ("start", name, attributes)
            if name in RAW or name in ESCAPED:
                end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
                inner = html[at : end.start() if end else size]
                if inner:
                    yield ("text", unescape(inner), None) if name in ESCAPED else ("raw", inner, None)
                at = end.start() if end else size
        elif nxt == "/" and html[lt + 2 : lt + 3].isascii() and html[lt + 2 : lt + 3].isalpha():
            name = _NAME.match(html, lt + 2).group().lower()
            _, at = _attributes(html, lt + 2 + len(name))
            if text:
                yield flush()
            if at < 0:
                return
            yield ("end", name, None)
        elif html.startswith("<!--", lt):
            if html.startswith((">", "->"), lt + 4):
                end, at = lt, html.index(">", lt + 4) + 1
            else:
                m = re.compile("--!?>").search(html, lt + 4)
                end, at = (m.start(), m.end()) if m else (size, size)
            if text:
                yield flush()
        elif nxt in ("!", "?", "/") and nxt:
            end = html.find(">", lt + 2)
            at = end + 1 if end >= 0 else size
            if text:
                yield flush()
        else:
            text.append("<")
            at = lt + 1
    if text:
        yield flush()


def page(html: str | None) -> tuple | None:
    """title, description, headings, text and links (address, text) of a page, as far as they go before it ends.

    The first title and description count; headings of the levels 1 to 3 are the texts within, empty ones left out;
    the text is all that a reader sees, its parts joined by a space; links come in the order of the page.
    """
    if html is None:
        return None
    title = description = None
    headings, parts, links, hidden = [], [], [], 0
    head, anchor = None, None
    in_title = False
    for kind, what, attributes in tokens(html):
        if kind == "start":
            if what in HIDDEN:
                hidden += 1
            elif what == "title":
                in_title = title is None
            elif what == "meta":
                if description is None and (attributes.get("name") or "").strip().lower() == "description":
                    description = attributes.get("content", "").strip() or None
            elif not hidden and what in ("h1", "h2", "h3"):
                head = []
            elif not hidden and what == "a" and "href" in attributes:
                anchor = (attributes["href"], [])
                links.append(anchor)
        elif kind == "end":
            if what in HIDDEN:
                hidden = max(0, hidden - 1)
            elif what == "title":
                in_title = False
            elif what in ("h1", "h2", "h3") and head is not None:
                headings.append(" ".join("".join(head).split()))
                head = None
            elif what == "a":
                anchor = None
        elif kind == "text" and not hidden:
            if in_title:
                title = (title or "") + what
            parts.append(what)
            if head is not None:
                head.append(what)
            if anchor:
                anchor[1].append(what)
    if head is not None:
        headings.append(" ".join("".join(head).split()))
    told = [{"href": a, "told": " ".join("".join(t).split())} for a, t in links]
    return (title.strip() if title is not None else "", description, [h for h in headings if h], " ".join(parts), told)


def first_texts(xml: str | None, tags: tuple[str, ...]) -> tuple:
    """The text within the first element of each tag of an XML document, "" where there is none, as XPath's ``string(//tag)``; nulls of null.

    Names are taken as written, prefixes included. A document that is no XML raises an error.
    """
    if xml is None:
        return (None,) * len(tags)
    found: dict[str, list[str]] = {}
    open_: list[list[str] | None] = []

    def start(name, _):
        new = name in tags and name not in found
        open_.append(found.setdefault(name, []) if new else None)

    def text(data):
        for held in open_:
            if held is not None:
                held.append(data)

    parser = expat.ParserCreate()
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, lambda _: open_.pop(), text
    parser.buffer_text = True
    parser.Parse(xml, True)
    return tuple("".join(found.get(t, ())) for t in tags)
