"""A small tolerant reader of HTML: elements, and the text blocks in them."""

from __future__ import annotations

import html
import re

#: Fixed values of the markup language: elements without content, elements whose
#: content is no markup, and elements that stand in a line of text.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
    "q ruby rt rp s samp small span strike strong sub sup time tt u var wbr img".split()
)
#: Elements that an equal or listed start tag ends.
_ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
    "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
}
#: Elements that an inner end tag or implied end does not reach beyond.
_SCOPE = frozenset("html body article main section div table td th ul ol dl aside nav".split())
#: Deeper elements are read as part of the one at this depth.
MAX_DEPTH = 200

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?][^>]*+>",
    re.DOTALL,
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true", re.I)


class Element:
    """An element: its tag, what names it, and its children, elements and texts.

    A text is a str; white space in it is one space and its ends are trimmed.
    """

    __slots__ = ("tag", "names", "hidden", "kids")

    def __init__(self, tag: str, names: str = "", hidden: bool = False):
        self.tag, self.names, self.hidden = tag, names, hidden
        self.kids: list[Element | str] = []


def parse(page: str) -> Element:
    """The tree of a page. Anything is accepted; text never gets lost but in
    elements of RAW, and inline elements are not kept apart."""
    root = Element("#root")
    stack = [root]
    pieces: list[str] = []

    def end_block() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            stack[-1].kids.append(text)

    at = 0
    while at < len(page):
        token = _TOKEN.search(page, at)
        if not token:
            pieces.append(page[at:])
            break
        pieces.append(page[at : token.start()])
        at = token.end()
        closing, tag, rest = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            pieces.append(" ")
        elif closing:
            if tag not in INLINE:
                end_block()
                _close(stack, tag)
        elif tag in RAW:
            if not rest.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
                at = page.find(">", end.start()) + 1 if end else len(page)
                at = at or len(page)
            if tag not in ("svg", "math"):
                end_block()
        elif tag not in INLINE:
            end_block()
            if tag not in VOID:
                _open(stack, tag, rest)
    end_block()
    return root


def _open(stack: list[Element], tag: str, rest: str) -> None:
    _imply_ends(stack, tag)
    if len(stack) < MAX_DEPTH:
        names = " ".join(m[2] or m[3] or m[4] or "" for m in _NAMES.finditer(rest)) if rest else ""
        node = Element(tag, names, bool(rest and _HIDDEN.search(rest)))
        stack[-1].kids.append(node)
        stack.append(node)


def _imply_ends(stack: list[Element], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        open_tag = stack[i].tag
        if open_tag == "p" or tag in _ENDED_BY.get(open_tag, ()):
            del stack[i:]
            return
        if open_tag in _SCOPE:
            return


def _close(stack: list[Element], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if stack[i].tag in ("article", "main", "body") and tag not in ("article", "main", "body", "html"):
            return
