"""A small reader of HTML: elements as a tree, text as pieces within blocks."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z|['\"][^>]*(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content isn't shown as text of the page.
_RAW = frozenset("script style template textarea title iframe noframes noscript svg".split())
#: A slash that closes a tag; one that ends an unquoted value doesn't.
_CLOSED = re.compile(r"(?:^|[\s\"'])/\Z")
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html label legend li main menu nav noscript ol option p pre search section select summary table tbody td tfoot th thead tr ul xmp".split()
)
#: Inline elements that are only marks on their block's text, unless they carry a class or an id.
_MARKS = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
# What an opening tag ends: the nearest of the first set, if nothing of the second lies above it.
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset()),
}
_NOT_IN_P = BLOCK - {"button", "label", "legend", "option", "select", "noscript"}
_P_SCOPE = (frozenset(["p"]), frozenset("td th table button body article section div li blockquote".split()))


@dataclass
class Node:
    tag: str
    parent: int
    attributes: dict[str, str] = field(default_factory=dict)
    text: int = 0
    links: int = 0
    stops: int = 0


@dataclass
class Page:
    """Elements, parents first, and the text of each block as (element, text) pieces in order."""

    nodes: list[Node]
    blocks: list[list[tuple[int, str]]]


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)} if raw else {}


def read(source: str) -> Page:
    """The tree of a page; broken markup is read as far as it makes sense.

    What isn't shown (scripts, styles, drawings, notices for readers without scripts)
    is left out up to its closing tag; without one, up to the end of its parent.
    """
    nodes = [Node("#page", -1)]
    blocks: list[list[tuple[int, str]]] = [[]]
    stack: list[tuple[str, int]] = [("#page", 0)]  # tag, and the element its text belongs to
    opened: dict[str, int] = {}
    endless: set[str] = set()  # tags of which no closing one is left
    at = 0

    def pop() -> None:
        tag, _ = stack.pop()
        opened[tag] -= 1
        if tag in BLOCK and blocks[-1]:
            blocks.append([])

    def end(tags: frozenset, barrier: frozenset) -> None:
        if not any(opened.get(t) for t in tags):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in tags:
                while len(stack) > depth:
                    pop()
                return
            if stack[depth][0] in barrier:
                return

    def add(text: str) -> None:
        if any(map(opened.get, _RAW)):
            return
        node = nodes[stack[-1][1]]
        blocks[-1].append((stack[-1][1], text))
        letters = len(text) - text.count(" ")
        node.text += letters
        node.stops += sum(map(text.count, ".,;!?"))
        if opened.get("a"):
            node.links += letters

    while True:
        m = _MARKUP.search(source, at)
        if m is None:
            break
        if m.start() > at:
            add(html.unescape(source[at : m.start()]))
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["close"]:
            if opened.get(tag):
                end(frozenset([tag]), frozenset())
            continue
        if tag == "br":
            blocks[-1].append((stack[-1][1], "\n"))
        if tag in BLOCK:
            if tag in _NOT_IN_P:
                end(*_P_SCOPE)
            if tag in _ENDS:
                end(*_ENDS[tag])
            if blocks[-1]:
                blocks.append([])
        attributes = _attributes(m["attributes"])
        own = stack[-1][1]
        formula = tag == "math" or opened.get("math")
        if not formula and (tag not in _MARKS or "class" in attributes or "id" in attributes):
            nodes.append(Node(tag, own, attributes))
            own = len(nodes) - 1
        closed = _CLOSED.search(m["attributes"]) is not None
        if tag in _VOID or (closed and tag not in _RAW - {"svg"}):
            continue
        if tag in _RAW or tag == "xmp":
            close = None if tag in endless else re.compile(f"</{tag}(?![A-Za-z0-9-])[^>]*(?:>|\\Z)", re.I).search(source, at)
            if close is None:
                endless.add(tag)
            elif tag == "xmp":
                stack.append((tag, own))
                add(source[at : close.start()])
                stack.pop()
                blocks.append([])
            if close:
                at = close.end()
                continue
        stack.append((tag, own))
        opened[tag] = opened.get(tag, 0) + 1
    if at < len(source):
        add(html.unescape(source[at:]))
    return Page(nodes, [b for b in blocks if b])
