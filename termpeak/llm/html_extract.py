"""Main text of web pages by wrapper induction over pages of one host.

Method. Every page becomes a tree of slots: blocks by element and class, with runs of
like siblings as one slot and chains of lone blocks as one. Pages of one host with the
same sectioning elements are a layout; of each, a page of middling size is the reference. All
its pages are aligned with it by simple tree matching, the largest order-preserving match
of equal labels. Each aligned leaf votes whether its text is the reference's. Leaves that
are constant over the layout are its template, those that vary its content.

A page's main text is what stands in its outermost main and article elements, in page
order, whole, but for those that are template from end to end; a heading of the first
rank that stands before an article without one belongs to it. Where no such element is
marked, it is the region that holds most varying text: the deepest slot that holds nearly
all of it, as aligned, without the constant leaves.

Alignment alone cannot tell an article from a menu or an advert that also vary, so
elements that say what they are (``nav``, ``footer``, class ``ad``, and so on) are never
content. A class or id says so only if all its words do (``related-posts``, but not
``related-work``), and it does not count for an element that holds the page's article or,
where none is marked, most of its text. Within an article or main element nothing else is
left out, as a paragraph that many pages share is still theirs.

Scale. Pages meet their layout's reference in a join, not in a group: no task holds a
host. References are broadcast up to a checked size; beyond it the join shuffles, with
large layouts dealt out over salts. Votes are summed in each batch before they are
shuffled. Trees live one page at a time; parsing takes time linear in the page, and long
lists of children are matched exactly in memory linear in their number.

Defined results: null or empty html gives empty text; a null or odd url is the host
``""``; layouts of one or two pages have no constant leaves; of two regions with equal
text the first in the page counts; repeated rows give repeated rows.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpeak.llm.common import checkpointed
from termpeak.llm.html_tree import BLOCKS, Node, parse

FEWEST = 3  # pages before a leaf can be called constant
CONSTANT = 0.9  # share of pages with the same text
MOST = 0.7  # share of the varying text that a slot needs to be the region
BROADCAST_BYTES = 32 << 20  # of all hosts' references and votes
SALTS = 64
TABLE = 40_000  # pairs of children that are matched with a whole table in memory

# Elements that are never part of the main text, wherever they stand.
_NEVER = frozenset(
    "script style noscript template svg canvas form button input select textarea iframe object "
    "embed nav footer aside dialog menu search head title audio video map datalist".split()
)
_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "form tooltip".split()
)
# Words of a class or id that say the same of any element.
_SAYS = frozenset(
    "ad ads adsbygoogle adsense adv advert adverts advertisement advertising alert banner banners breadcrumb "
    "breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr menu "
    "modal nav navbar navigation newsletter notice notices overlay popup promo promotion "
    "related replies reply respond share sharing sidebar sidebars skip social sponsor "
    "sponsored subscribe subscription toolbar widget widgets".split()
)
# Words that go with these and say nothing of their own.
_BESIDE = frozenset(
    "area article articles bar bars block blocks body bottom box boxes button buttons col column "
    "container content desktop global holder icon icons id inner item items left link links list "
    "main media mobile outer panel post posts primary right row secondary section site slot "
    "sticky text title to top unit wrap wrapper x xs sm md lg xl js the my".split()
)
# And those that say it outside an article only, where they are a page's header.
_OUTSIDE = frozenset(["header", "masthead", "topbar"])
# An article that says this is none: a reader's comment, an advert, a teaser.
_NO_ARTICLE = frozenset(
    "ad ads advert advertisement comment comments promo promotion related reply sponsor "
    "sponsored teaser".split()
)
# What readers write may be longer than the article, and is none of it all the same.
_READERS = frozenset("comment comments commentlist disqus replies reply respond".split())
# Words by which an element speaks of the page's layout and not of itself.
_LAYOUT = frozenset("has with no without layout page".split())
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_MAIN = ("article", "main")
_WORD = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _names(node: Node) -> list[set[str]]:
    """The words of each class and of the id."""
    own = node.attributes
    raw = f"{own.get('class', '')} {own.get('id', '')}"
    if raw == " ":
        return []
    return [set(_WORD.findall(_CAMEL.sub(" ", name).lower())) for name in raw.split()]


def _says(names: list[set[str]], words: frozenset[str]) -> bool:
    """Whether some name has one of the words and none of a meaning of its own."""
    return any(
        own & words and all(w in words or w in _BESIDE or w.isdigit() for w in own)
        for own in names
    )


def by_name(node: Node) -> bool:
    """Whether an element is left out for what it calls itself, or as a form."""
    if node.tag == "form":
        return True
    if not node.attributes or node.tag in ("html", "body", *_MAIN):
        return False
    names = _names(node)
    return _says(names, _SAYS) and not set().union(*names) & _LAYOUT


def boilerplate(node: Node, inside: bool) -> bool:
    """Whether an element is none of the main text; ``inside`` an article or main."""
    if node.tag in _NEVER:
        return not (node.tag == "form" and node.spared)
    own = node.attributes
    if not own:
        return node.tag == "header" and not inside
    if "hidden" in own or own.get("aria-hidden") == "true" or own.get("role", "") in _ROLES:
        return True
    if _UNSEEN.search(own.get("style", "")):
        return True
    if node.tag in ("html", "body"):
        return False
    if node.tag in _MAIN:
        return any(name & _NO_ARTICLE for name in _names(node))
    if by_name(node) and not node.spared:
        return True
    return not inside and (node.tag == "header" or _says(_names(node), _OUTSIDE))


def is_main(node: Node) -> bool:
    return node.tag in _MAIN or node.attributes.get("role") == "main"


def main_regions(root: Node) -> list[Node]:
    """The outermost main and article elements, in page order.

    A first-rank heading outside them comes along if it stands before an article and
    they have none.
    """
    regions: list[Node] = []
    headings: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if is_main(node) and not boilerplate(node, False):
            regions.append(node)
        elif node.tag == "h1" and not regions and not boilerplate(node, False):
            headings.append(node)
        elif not boilerplate(node, False):
            todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    if regions and headings and not any(_has(r, "h1") for r in regions):
        return [*headings, *regions]
    return regions


def _has(node: Node, tag: str) -> bool:
    todo = [node]
    while todo:
        own = todo.pop()
        if own.tag == tag:
            return True
        todo.extend(c for c in own.children if isinstance(c, Node))
    return False


def page_tree(html: str) -> Node:
    """The tree of a page; elements that hold its main text are spared.

    Should what elements call themselves leave no article, those that hold one are
    spared; and where none is marked, those that hold more than half of all text.
    """
    root = parse(html)
    if any(blocks([r], first=True) for r in main_regions(root)):
        return root
    named, weight, holds = _weighed(root)
    for node in named:
        node.spared = holds[id(node)]
    if any(blocks([r], first=True) for r in main_regions(root)):
        return root
    total = weight[id(root)]
    for node in named:
        read = not any(n & _READERS for n in _names(node))
        node.spared = node.spared or (read and 2 * weight[id(node)] > total)
    return root


def _weighed(root: Node) -> tuple[list[Node], dict[int, int], dict[int, bool]]:
    """Elements left out by name, the characters in each element, and whether it holds
    an article or main."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        if node.tag not in _NEVER or node.tag == "form":
            todo.extend(c for c in node.children if isinstance(c, Node))
    weight: dict[int, int] = {}
    holds: dict[int, bool] = {}
    for node in reversed(order):
        inner = [c for c in node.children if isinstance(c, Node)]
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        unread = node.tag in _NEVER and node.tag != "form"
        weight[id(node)] = 0 if unread else own + sum(weight.get(id(c), 0) for c in inner)
        holds[id(node)] = any(
            holds.get(id(c), False) or is_main(c) and not boilerplate(c, False) for c in inner
        )
    return [n for n in order if by_name(n)], weight, holds


def blocks(
    nodes: list[Node], left_out: frozenset[int] = frozenset(), first: bool = False
) -> list[str]:
    """Texts of the blocks of some elements, in page order, without empty ones.

    ``left_out`` has the ``id()`` of further elements to pass over; ``first``: no more
    than the first block, to see if there is any.
    """
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        if text:
            out.append(text)
        held.clear()

    todo: list = [(n, False) for n in reversed(nodes)]
    while todo and not (first and out):
        item, inside = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            held.append(item)
        elif item.tag == "br":
            held.append(" ")
        elif boilerplate(item, inside) or id(item) in left_out:
            if item.tag in BLOCKS:
                flush()
        else:
            inside = inside or is_main(item)
            block = item.tag in BLOCKS
            if block:
                flush()
                todo.append((None, inside))
            todo.extend((c, inside) for c in reversed(item.children))
    flush()
    return out


@dataclass(eq=False)
class Slot:
    """A run of like siblings, and the slots within them."""

    label: str
    nodes: list[Node]
    inside: bool
    kids: list[Slot] = field(default_factory=list)
    number: int = 0


def _label(node: Node) -> str:
    names = node.attributes.get("class", "") if node.attributes else ""
    return f"{node.tag}.{'.'.join(sorted(names.split()))}" if names else node.tag


def _inner_blocks(node: Node) -> list[Node]:
    return [c for c in node.children if isinstance(c, Node) and c.tag in BLOCKS]


def slots_of(root: Node) -> list[Slot]:
    """All slots of a page in page order, the whole page first; no boilerplate.

    A slot of one element with one block in it and no text beside that block stands for
    both, so that wrappers around wrappers make no levels.
    """
    top = Slot("#page", [root], False)
    out = [top]
    todo = [top]
    while todo:
        slot = todo.pop()
        if slot is not top:
            _narrow(slot)
        last: Slot | None = None
        for node in slot.nodes:
            for child in _inner_blocks(node):
                if boilerplate(child, slot.inside):
                    continue
                label = _label(child)
                if last is not None and last.label == label:
                    last.nodes.append(child)
                else:
                    last = Slot(label, [child], slot.inside or is_main(child))
                    slot.kids.append(last)
        todo.extend(reversed(slot.kids))
        if slot is not top:
            out.append(slot)
    for k, slot in enumerate(out):
        slot.number = k
    return out


def _narrow(slot: Slot) -> None:
    """Go down a chain of lone blocks, up to a main element or to what is more."""
    while len(slot.nodes) == 1 and not is_main(slot.nodes[0]):
        node = slot.nodes[0]
        if len(node.children) != 1 or not isinstance(node.children[0], Node):
            return
        child = node.children[0]
        if child.tag not in BLOCKS or boilerplate(child, slot.inside):
            return
        slot.label = f"{slot.label}/{_label(child)}"
        slot.nodes = [child]
        slot.inside = slot.inside or is_main(child)


def align(one: Slot, two: Slot) -> dict[int, Slot]:
    """Numbers of ``one``'s slots with the slots of ``two`` they match.

    Simple tree matching: slots match if their labels do, and their kids match in
    order so that most slots are matched in all.
    """
    weights: dict[tuple[int, int], int] = {}
    tables: dict[tuple[int, int], list[list[int]]] = {}

    def weigh(a: Slot, b: Slot) -> int:
        if a.label != b.label:
            return 0
        known = weights.get((a.number, b.number))
        if known is not None:
            return known
        n, m = len(a.kids), len(b.kids)
        if not n or not m:
            best = 0
        elif n * m > TABLE:
            best = int(_last_row(a.kids, b.kids, weigh)[-1])
        else:
            table = [[0] * (m + 1) for _ in range(n + 1)]
            for i in range(1, n + 1):
                row, above, kid = table[i], table[i - 1], a.kids[i - 1]
                for j in range(1, m + 1):
                    own = weigh(kid, b.kids[j - 1])
                    row[j] = max(row[j - 1], above[j], above[j - 1] + own if own else 0)
            best = table[n][m]
            tables[a.number, b.number] = table
        weights[a.number, b.number] = best + 1
        return best + 1

    found: dict[int, Slot] = {}
    limit = sys.getrecursionlimit()
    # calls go as deep as the slots do; calls of Python functions take no machine stack
    sys.setrecursionlimit(max(limit, 10_000 + 4 * _depth(one)))
    try:
        if not weigh(one, two):
            return found
        todo = [(one, two)]
        while todo:
            a, b = todo.pop()
            found[a.number] = b
            i, j = len(a.kids), len(b.kids)
            if i * j > TABLE:
                todo.extend(_pairs(a.kids, b.kids, weigh))
                continue
            table = tables.get((a.number, b.number))
            while i and j and table:
                own = weigh(a.kids[i - 1], b.kids[j - 1])
                if own and table[i][j] == table[i - 1][j - 1] + own:
                    todo.append((a.kids[i - 1], b.kids[j - 1]))
                    i, j = i - 1, j - 1
                elif table[i][j] == table[i - 1][j]:
                    i -= 1
                else:
                    j -= 1
    finally:
        sys.setrecursionlimit(limit)
    return found


def _depth(slot: Slot) -> int:
    level, depth = [slot], 0
    while level:
        level, depth = [k for s in level for k in s.kids], depth + 1
    return depth


def _last_row(one: list[Slot], two: list[Slot], weigh: Callable[[Slot, Slot], int]) -> np.ndarray:
    """The weight of the best match of ``one`` with every beginning of ``two``."""
    places: dict[str, list[int]] = {}
    for j, kid in enumerate(two):
        places.setdefault(kid.label, []).append(j)
    at = {label: np.array(own) for label, own in places.items()}
    plain = {label: all(not two[j].kids for j in own) for label, own in places.items()}
    row = np.zeros(len(two) + 1, np.int64)
    for kid in one:
        where = at.get(kid.label)
        if where is None:
            continue
        if not kid.kids or plain[kid.label]:
            own = 1
        else:
            own = np.array([weigh(kid, two[j]) for j in where.tolist()])
        diagonal = row.copy()
        diagonal[where + 1] = np.maximum(diagonal[where + 1], row[where] + own)
        row = np.maximum.accumulate(diagonal)
    return row


def _pairs(
    one: list[Slot], two: list[Slot], weigh: Callable[[Slot, Slot], int]
) -> list[tuple[Slot, Slot]]:
    """The pairs of the best match, in memory linear in the lists: the first half of
    ``one`` goes with that beginning of ``two`` which is best for both halves."""
    out: list[tuple[Slot, Slot]] = []
    todo = [(one, two)]
    while todo:
        a, b = todo.pop()
        if not a or not b:
            continue
        if len(a) == 1:
            own = [weigh(a[0], kid) for kid in b]
            if max(own):
                out.append((a[0], b[own.index(max(own))]))
            continue
        half = len(a) // 2
        before = _last_row(a[:half], b, weigh)
        after = _last_row(a[half:][::-1], b[::-1], weigh)[::-1]
        cut = int(np.argmax(before + after))
        todo += [(a[:half], b[:cut]), (a[half:], b[cut:])]
    return out


@dataclass(frozen=True)
class Vote:
    pages: int
    same: int
    chars: int


class Wrapper:
    """What is known of a layout: its reference page and the votes on its leaves."""

    def __init__(self, html: str, votes: dict[int, Vote] | None = None) -> None:
        self.slots = slots_of(page_tree(html))
        self.votes = votes or {}
        self.constant = {
            k
            for k, v in self.votes.items()
            if v.pages >= FEWEST and v.same >= CONSTANT * v.pages
        }
        varying = {k: v.chars for k, v in self.votes.items() if k not in self.constant}
        self.region = region(self.slots, varying)
        self.texts: dict[int, str] = {}

    def votes_of(self, html: str) -> list[tuple[int, int, int]]:
        """Of every aligned leaf: its number, whether the text is the same, its length."""
        page = slots_of(page_tree(html))
        out = []
        for number, slot in align(self.slots[0], page[0]).items():
            own = self.slots[number]
            if not own.kids:
                text = "\n".join(blocks(slot.nodes))
                out.append((number, int(text == self.leaf_text(number)), len(text)))
        return out

    def leaf_text(self, number: int) -> str:
        if number not in self.texts:
            self.texts[number] = "\n".join(blocks(self.slots[number].nodes))
        return self.texts[number]

    def text_of(self, html: str) -> str:
        """The main text of a page of this layout."""
        root = page_tree(html)
        page = slots_of(root)
        matched = align(self.slots[0], page[0])
        fixed = frozenset(
            id(n)
            for k in self.constant
            if k in matched and not matched[k].kids
            for n in matched[k].nodes
        )
        regions = [r for r in main_regions(root) if blocks([r], first=True)]
        if len(regions) > 1:
            live = [r for r in regions if r.tag == "h1" or blocks([r], fixed, first=True)]
            regions = live if any(is_main(r) for r in live) else regions
        if regions:
            return "\n".join(blocks(regions))
        chosen = matched.get(self.region.number)
        if chosen is None:
            mass = {s.number: sum(map(len, blocks(s.nodes))) for s in page if not s.kids}
            chosen = region(page, mass)
        return "\n".join(blocks(chosen.nodes, fixed))


def region(slots: list[Slot], chars: dict[int, int]) -> Slot:
    """The slot of the main text, by the varying characters of the leaves."""
    mass: dict[int, int] = {}
    for slot in reversed(slots):
        own = sum(mass[k.number] for k in slot.kids) if slot.kids else chars.get(slot.number, 0)
        mass[slot.number] = own
    here = slots[0]
    while here.kids:
        heavy = max(here.kids, key=lambda s: (mass[s.number], -s.number))
        if not heavy.kids or mass[heavy.number] < MOST * mass[here.number] or not mass[heavy.number]:
            break
        here = heavy
    return here


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def layout_of(html: Column) -> Column:
    """The sectioning elements that a page has, by name; pages of one host that differ
    in these are not aligned with each other."""
    tags = F.regexp_extract_all(
        html, F.lit(r"<(article|aside|footer|form|header|main|nav|section|table)[\s>]"), F.lit(1)
    )
    return F.array_join(F.array_sort(F.array_distinct(tags)), ",")


class _Recent(dict):
    """The wrappers of the layouts met last; within a task pages come sorted by these."""

    def of(self, host: str, make) -> Wrapper:
        if host not in self:
            if len(self) >= 64:
                self.clear()
            self[host] = make()
        return self[host]


def _count_votes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    recent = _Recent()
    for frame in frames:
        sums: dict[tuple[str, int], list[int]] = {}
        for host, html, reference in frame[["host", "html", "reference"]].itertuples(index=False):
            wrapper = recent.of(host, lambda html=reference: Wrapper(html))
            for number, same, chars in wrapper.votes_of(html):
                own = sums.setdefault((host, number), [0, 0, 0])
                own[0] += 1
                own[1] += same
                own[2] += chars
        rows = [(*key, *own) for key, own in sums.items()]
        yield pd.DataFrame(rows, columns=["host", "leaf", "pages", "same", "chars"])


def _extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    recent = _Recent()
    for frame in frames:
        texts = []
        for row in frame.itertuples(index=False):
            votes = row.votes

            def make(html: str = row.reference, votes=votes) -> Wrapper:
                known = {v["leaf"]: Vote(v["pages"], v["same"], v["chars"]) for v in votes}
                return Wrapper(html, known)

            texts.append(recent.of(row.host, make).text_of(row.html))
        yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts})


def _beside(pages: DataFrame, table: DataFrame) -> DataFrame:
    """``pages`` with the row of ``table``, which has one for every host, of their host.

    A table of up to ``BROADCAST_BYTES`` is broadcast, so that pages stay where they
    are. A larger one is joined by a shuffle, in which the pages of hosts with a
    thousandth of all pages or more, of which there are a thousand at most, are dealt
    out over ``SALTS`` parts.
    """
    if (table.agg(F.sum("bytes")).first()[0] or 0) <= BROADCAST_BYTES:
        return pages.join(F.broadcast(table), "host")
    counts = checkpointed(pages.groupBy("host").count())
    total = counts.agg(F.sum("count")).first()[0]
    large = F.broadcast(
        counts.where(F.col("count") * 1000 >= total).select("host", F.lit(SALTS).alias("salts"))
    )
    salts = F.coalesce("salts", F.lit(1))
    own = pages.join(large, "host", "left").withColumn(
        "salt", F.pmod(F.monotonically_increasing_id(), salts).cast("int")
    )
    dealt = table.join(large, "host", "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    return own.drop("salts").join(dealt.drop("salts"), ["host", "salt"])


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """``host``, ``reference`` (html of one page), ``votes`` on its leaves, ``bytes``.

    What is called the host here is a host and a layout. The reference is the page with
    text whose number of tags is nearest to the middle of all: not an empty page or an
    error page, unless the host has nothing else.
    """
    tags = F.regexp_count("html", F.lit("<"))
    has_text = F.regexp_like("html", F.lit(r">\s*[^<\s]|^\s*[^<\s]"))
    sized = pages.select("*", F.when(has_text, tags).alias("tags"))
    middle = sized.groupBy("host").agg(
        F.coalesce(F.percentile_approx("tags", 0.5, 1000), F.lit(0)).alias("middle")
    )
    middles = checkpointed(middle.withColumn("bytes", F.octet_length("host") + 100))
    away = F.struct(
        F.col("tags").isNull(), F.abs(F.col("tags") - F.col("middle")), F.xxhash64("html"), "html"
    )
    references = checkpointed(
        _beside(sized, middles)
        .groupBy("host")
        .agg(F.min_by("html", away).alias("reference"))
        .withColumn("bytes", F.octet_length("reference") + F.octet_length("host") + 100)
    )
    votes = (
        _beside(pages, references)
        .select("host", "html", "reference")
        .sortWithinPartitions("host")  # a host's pages in a row share one parsed reference
        .mapInPandas(_count_votes, "host string, leaf int, pages long, same long, chars long")
        .groupBy("host", "leaf")
        .agg(F.sum("pages").alias("pages"), F.sum("same").alias("same"), F.sum("chars").alias("chars"))
        .groupBy("host")
        .agg(F.collect_list(F.struct("leaf", "pages", "same", "chars")).alias("votes"))
    )
    none = F.array().cast("array<struct<leaf:int,pages:bigint,same:bigint,chars:bigint>>")
    wrappers = references.join(votes, "host", "left").select(
        "host",
        "reference",
        F.coalesce("votes", none).alias("votes"),
        (F.col("bytes") + 40 * F.coalesce(F.size("votes"), F.lit(0))).alias("bytes"),
    )
    return checkpointed(wrappers)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` of every page."""
    own = pages.select(
        "page_id",
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
        F.concat_ws(
            "\n", host_of(F.col("url")), layout_of(F.coalesce("html", F.lit("")))
        ).alias("host"),
    )
    kind = dict(pages.dtypes)
    return (
        _beside(own, induce_wrappers(own))
        .select("page_id", "url", "html", "host", "reference", "votes")
        .sortWithinPartitions("host")
        .mapInPandas(_extract, f"page_id {kind['page_id']}, url string, text string")
    )


def extraction_query(pages: DataFrame) -> DataFrame:
    return extract_text(pages).withColumn("n_chars", F.length("text").cast("bigint"))
