"""A small HTML tree: enough structure to align pages and to read their blocks."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol option p pre search section summary table tbody td tfoot th thead tr "
    "ul".split()
)
# Start tags that end an open element of one of these names, up to the given borders.
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
_P = (frozenset(["p"]), frozenset(["table", "td", "th", "button", "caption", "object"]))

# What ends at a mark of its own; never more than one way to match, so linear.
_ASIDE = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*>?", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
# The rest of a tag: a quote counts only after an equals sign, as in browsers. Nothing is
# tried twice (``*+``); a quote that never ends is no quote.
_REST = re.compile(r"(?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+>")
_ATTRIBUTE = re.compile(
    r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?"
)


class Node:
    """An element; its children are elements and decoded strings in page order.

    ``spared``: whether it counts as text whatever its names say.
    """

    __slots__ = ("tag", "attributes", "children", "spared")

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag = tag
        self.attributes = attributes
        self.children: list[Node | str] = []
        self.spared = False


def _attributes(source: str) -> dict[str, str]:
    if not source.strip(" /\t\n\r\f"):
        return {}
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


class _Open:
    """The open elements, and how many of each name, so that no search is in vain."""

    def __init__(self) -> None:
        self.nodes = [Node("#page", {})]
        self.counts: Counter[str] = Counter()

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.counts[node.tag] += 1

    def cut(self, k: int) -> None:
        for node in self.nodes[k:]:
            self.counts[node.tag] -= 1
        del self.nodes[k:]

    def end(self, names: frozenset, borders: frozenset) -> None:
        """End the innermost element of these names, if no border lies around it."""
        if not any(self.counts[n] for n in names):
            return
        for k in range(len(self.nodes) - 1, 0, -1):
            if self.nodes[k].tag in names:
                self.cut(k)
                return
            if self.nodes[k].tag in borders:
                return

    def close(self, tag: str) -> None:
        if not self.counts[tag]:
            return
        for k in range(len(self.nodes) - 1, 0, -1):
            if self.nodes[k].tag == tag:
                self.cut(k)
                return
            # an inline end tag does not close the blocks around it
            if self.nodes[k].tag in BLOCKS and tag not in BLOCKS:
                return


def parse(html: str) -> Node:
    """The tree of a page, however broken its markup, in time linear in its length.

    A tag that never ends is text, as is all after it.
    """
    open_ = _Open()
    top = open_.nodes[0]
    held: list[str] = []

    def flush() -> None:
        if held:
            open_.nodes[-1].children.append(unescape("".join(held)))
            held.clear()

    at, last = 0, html.rfind(">")
    while True:
        start = html.find("<", at)
        if start < 0 or start > last and not html.startswith(("<!", "<?"), start):
            held.append(html[at:])
            flush()
            return top
        if start > at:
            held.append(html[at:start])
        aside = _ASIDE.match(html, start)
        if aside:
            if aside.group(1) is not None:
                flush()
                open_.nodes[-1].children.append(aside.group(1))
            at = aside.end()
            continue
        named = _TAG.match(html, start)
        if not named:
            held.append("<")
            at = start + 1
            continue
        rest = _REST.match(html, named.end())
        at = rest.end() if rest else html.index(">", named.end() - 1) + 1
        flush()
        tag = named.group(2).lower()
        if named.group(1):
            open_.close(tag)
            continue
        if tag in _ENDS:
            open_.end(*_ENDS[tag])
        if tag in BLOCKS:
            open_.end(*_P)
        node = Node(tag, _attributes(html[named.end() : at - 1]))
        open_.nodes[-1].children.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            stop = close.start() if close else len(html)
            if tag not in ("script", "style"):
                node.children.append(unescape(html[at:stop]))
            at = close.end() if close else len(html)
        elif tag not in VOID:
            open_.push(node)
