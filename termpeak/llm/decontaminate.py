"""Benchmark decontamination with a generalised suffix automaton of the test items.

Method. The automaton has a path for every run of words of every item. A document
is streamed through it word by word, keeping the length of the longest run that
ends here and occurs in some item. Where that length reaches the window (13 words,
or all words of an item that has fewer), the run is a hit: its words are marked
and the items that have the window are noted. A document is contaminated if it has
a hit and the marked words are at least the coverage limit's share of its words. On
demand, the marked words of the other documents are cut out of their texts. What stood
before and after a cut may make a window together; so a text is scanned and cut again
until no hit is left in it.

Scale. Documents are read once, never shuffled, and every task holds one
automaton. Its size is checked: items are taken in blocks of at most
``BLOCK_BYTES`` of text, each block is broadcast by itself, and the hits of
several blocks are put together per text. One item larger than a block is a block.

Defined results: null or wordless texts and items have no windows; an item with a
null ``item_id`` marks words but is not listed; items that share an ``item_id``
count once; rows that repeat give rows that repeat. Empty tables are no special
case. Columns other than those named are passed over untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpeak.llm.common import (
    WORD_BYTES,
    alnum_words,
    carried,
    checkpointed,
    encoded,
    restored,
    small_batches,
    written,
)

WINDOW = 13
COVERAGE = 20  # one marked word in so many words contaminates
BLOCK_BYTES = 4 << 20
_WORD = re.compile(rb"\S+")

_HITS = (
    "struct<n_words:bigint,n_hit:bigint,"
    "spans:array<struct<first:int,last:int>>,items:array<string>>"
)


class SuffixAutomaton:
    """Every run of words of the items, with the windows that make a hit."""

    def __init__(self, items: Iterable[tuple[str | None, str | None]], window: int) -> None:
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.length = [0]
        self.link = [-1]
        texts = [(name, alnum_words(text)) for name, text in items]
        for _, words in texts:
            self._extend(words)
        self._place_windows(texts)

    def _extend(self, words: list[bytes]) -> None:
        """Blumer's online construction, generalised by restarting at the root."""
        step, length, link = self.step, self.length, self.link
        last = 0
        for word in words:
            known = step[last].get(word)
            if known is not None and length[known] == length[last] + 1:
                last = known
                continue
            if known is None:
                new = len(step)
                step.append({})
                length.append(length[last] + 1)
                link.append(0)
                state = last
                while state != -1 and word not in step[state]:
                    step[state][word] = new
                    state = link[state]
                if state == -1:
                    last = new
                    continue
                link[new] = self._split(state, word)
                last = new
            else:
                last = self._split(last, word)

    def _split(self, state: int, word: bytes) -> int:
        """The state of the runs that ``word`` makes of ``state``'s, cloned if needed."""
        step, length, link = self.step, self.length, self.link
        target = step[state][word]
        if length[target] == length[state] + 1:
            return target
        clone = len(step)
        step.append(dict(step[target]))
        length.append(length[state] + 1)
        link.append(link[target])
        link[target] = clone
        while state != -1 and step[state].get(word) == target:
            step[state][word] = clone
            state = link[state]
        return clone

    def _place_windows(self, texts: list[tuple[str | None, list[bytes]]]) -> None:
        """Note at the state of every window its length and its items."""
        own: dict[int, dict[int, set]] = {}
        for name, words in texts:
            size = min(self.window, len(words))
            state = run = 0
            for word in words:
                while word not in self.step[state]:
                    state = self.link[state]
                state, run = self.step[state][word], run + 1
                if run >= size:
                    at = state
                    while self.length[self.link[at]] >= size:
                        at = self.link[at]
                    own.setdefault(at, {}).setdefault(size, set()).add(name)
        # a run has every shorter run that ends with it: gather along the links
        self.windows: list[tuple[tuple[int, frozenset], ...]] = [()] * len(self.step)
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            mine = [(n, frozenset(i)) for n, i in sorted(own.get(state, {}).items())]
            self.windows[state] = (*self.windows[self.link[state]], *mine)
        self.shortest = [w[0][0] if w else 1 << 30 for w in self.windows]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Marked spans, merged and in order, as first and last word; their items."""
        step, link, length, shortest = self.step, self.link, self.length, self.shortest
        spans: list[tuple[int, int]] = []
        items: set = set()
        state = run = 0
        root = step[0]
        for at, word in enumerate(words):
            following = step[state].get(word)
            if following is not None:
                state, run = following, run + 1
            else:
                while state and word not in step[state]:
                    state = link[state]
                run = length[state]
                following = step[state].get(word) if state else root.get(word)
                if following is None:
                    state = run = 0
                    continue
                state, run = following, run + 1
            if run >= shortest[state]:
                longest = 0
                for size, names in self.windows[state]:
                    if size > run:
                        break
                    longest = size
                    items |= names
                first = at - longest + 1
                while spans and spans[-1][1] >= first - 1:
                    first = min(first, spans.pop()[0])
                spans.append((first, at))
        return spans, items


# The automaton met last, kept for the tasks that follow in this Python process.
_LAST: dict[tuple, SuffixAutomaton] = {}


def automaton_of(rows: list[tuple[str | None, str | None]], window: int) -> SuffixAutomaton:
    """The automaton of a block of items, built once in each Python process."""
    key = (window, len(rows), hashlib.sha256(repr(rows).encode("utf-8", "replace")).digest())
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = SuffixAutomaton(rows, window)
    return _LAST[key]


def _number_blocks(benchmark: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """The items with the number of their block; how many blocks there are."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * size // limit)) if size > limit else 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return benchmark.distinct().withColumn("block", block), blocks


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``hits``: ``n_words``, ``n_hit``, ``spans`` and sorted ``items``.

    ``docs`` needs ``text``; ``benchmark`` has ``item_id`` and ``text``.
    """
    named = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    numbered, count = _number_blocks(named, block_bytes)
    if count == 1:
        return docs.withColumn("hits", _scan(docs, numbered, window, F.col("text")))
    # Beyond one block: the texts are scanned once per block and the hits of a
    # text, which are few, are put together by the text's hash.
    key = F.sha2(F.coalesce("text", F.lit("")), 256)
    texts = docs.select(F.col("text").alias("text"), key.alias("key"))
    found = None
    for block in range(count):
        items = numbered.where(F.col("block") == block)
        part = texts.select("key", _scan(docs, items, window, F.col("text")).alias("hits"))
        part = part.where("hits.n_hit > 0").dropDuplicates(["key"])
        found = part if found is None else found.unionAll(part)
    merged = checkpointed(
        found.groupBy("key").agg(
            F.flatten(F.collect_list("hits.spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits.items")))).alias("items"),
        )
    )
    width = F.size(F.array_distinct(F.flatten(F.transform("spans", _covered))))
    merged = merged.select(
        F.col("key").alias("__hits_key"),
        F.struct(width.cast("long").alias("n_hit"), "spans", "items").alias("__hits"),
    )
    return (
        docs.withColumn("__hits_key", key)
        .join(merged, "__hits_key", "left")
        .withColumn(
            "hits",
            F.struct(
                _word_count(F.col("text")).alias("n_words"),
                F.coalesce(F.col("__hits.n_hit"), F.lit(0).cast("long")).alias("n_hit"),
                F.coalesce(F.col("__hits.spans"), F.array()).alias("spans"),
                F.coalesce(F.col("__hits.items"), F.array().cast("array<string>")).alias("items"),
            ),
        )
        .drop("__hits_key", "__hits")
    )


def _covered(span: Column) -> Column:
    return F.sequence(span["first"], span["last"])


def _word_count(text: Column) -> Column:
    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(alnum_words(t)) for t in texts], dtype="int64")

    return count(F.coalesce(text, F.lit("")))


def _scan(docs: DataFrame, items: DataFrame, window: int, text: Column) -> Column:
    """The hits of one block of items, whose size is bounded, in every text."""
    rows = [(r[0], r[1]) for r in items.select("item_id", "text").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    @F.pandas_udf(_HITS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = automaton_of(shared.value, window)
        for texts in batches:
            out = []
            for value in texts:
                words = alnum_words(value)
                spans, names = automaton.hits(words)
                names.discard(None)
                marked = sum(b - a + 1 for a, b in spans)
                pieces = [{"first": a, "last": b} for a, b in spans]
                out.append((len(words), marked, pieces, sorted(names)))
            yield pd.DataFrame(out, columns=["n_words", "n_hit", "spans", "items"])

    return scan(F.coalesce(text, F.lit("")))


def contaminated(hits: Column, coverage: int = COVERAGE) -> Column:
    return (hits["n_hit"] > 0) & (coverage * hits["n_hit"] >= hits["n_words"])


def without_spans(text: str, spans: Iterable[tuple[int, int]]) -> str:
    """``text`` with a line's end in the place of each span, from its first word to its last.

    Spans may overlap and come in any order; what lies between two words is no word's.
    """
    raw = encoded(text)
    words = [m.span() for m in _WORD.finditer(raw.translate(WORD_BYTES))]
    parts, at, done = [], 0, -1
    for first, last in sorted(spans):
        if first > done:
            parts += [raw[at : words[first][0]], b"\n"]
        done = max(done, last)
        at = words[done][1]
    return b"".join([*parts, raw[at:]]).decode("utf-8", "surrogatepass")


def _without_spans(text: Column, hits: Column) -> Column:
    """The text with its marked spans cut out; only texts with a hit go to Python."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        rows = [
            None if t is None else without_spans(t, [(p["first"], p["last"]) for p in own])
            for t, own in zip(texts, spans, strict=True)
        ]
        return pd.Series(rows, dtype=object)

    hit = hits["n_hit"] > 0
    return F.when(hit, cut(F.when(hit, text), hits["spans"])).otherwise(text)


def cut_until_clean(automaton: SuffixAutomaton, text: str) -> str:
    """``text`` without hits; each cut takes words away, so this ends."""
    while spans := automaton.hits(alnum_words(text))[0]:
        text = without_spans(text, spans)
    return text


def _cleaned(docs: DataFrame, items: DataFrame, text: Column, hits: Column) -> Column:
    """As :func:`cut_until_clean`, for the items of one block."""
    rows = [(r[0], r[1]) for r in items.select("item_id", "text").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        found = [
            None if t is None else cut_until_clean(automaton_of(shared.value, WINDOW), t)
            for t in texts
        ]
        return pd.Series(found, dtype=object)

    hit = hits["n_hit"] > 0
    return F.when(hit, clean(F.when(hit, text))).otherwise(text)


def decontaminate(docs: DataFrame, benchmark: DataFrame, cut: bool = False) -> DataFrame:
    """``docs`` without contaminated documents; the others are left as they are.

    With ``cut``, the others lose the words of every hit in ``text``, until none is left,
    so that no benchmark text stays in documents that have too little of it to go. That
    result is written and read again, as texts go to Python in small batches for it.
    """
    if cut:
        with small_batches(docs.sparkSession):
            return written(_cut(docs, benchmark), "decontaminated")
    found = find_hits(carried(docs, "text"), benchmark)
    return restored(found.where(~contaminated(F.col("hits"))))


def _cut(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that stay, without the words of their hits."""
    found = find_hits(carried(docs, "text"), benchmark)
    hits = F.col("hits")
    kept = found.where(~contaminated(hits))
    named = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    numbered, blocks = _number_blocks(named, BLOCK_BYTES)
    if blocks == 1:
        return restored(kept, text=_cleaned(docs, numbered, F.col("text"), hits))
    # More blocks than a task may hold: cut, and scan what was cut again, block by block.
    kept = written(kept, "scanned")
    clean = kept.where("hits.n_hit = 0").select("row", "text")
    while not (open_ := kept.where("hits.n_hit > 0")).isEmpty():
        shorter = open_.select("row", _without_spans(F.col("text"), hits).alias("text"))
        kept = written(find_hits(shorter, benchmark), "scanned")
        clean = clean.unionAll(kept.where("hits.n_hit = 0").select("row", "text"))
    return restored(clean, text=F.col("text"))


def decontamination_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    hits = F.col("hits")
    return find_hits(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"),
        contaminated(hits).alias("contaminated"),
    )


def _words_sql(text: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = f"translate({text}, '{upper}', '{upper.lower()}')"
    spaced = f"regexp_replace({lowered}, '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g')"
    return f"list_filter(string_split(coalesce({spaced}, ''), ' '), lambda w: w <> '')"


DECONTAMINATION_SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_words_sql("text")} AS w FROM documents
),
items AS (
    SELECT item_id, w, least({WINDOW}, len(w)) AS k
    FROM (SELECT item_id, {_words_sql("text")} AS w FROM benchmark)
),
windows AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS run
    FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM items WHERE k > 0)
),
runs AS (
    SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS run
    FROM (
        SELECT d.r, d.w, s.k, unnest(range(1, len(d.w) - s.k + 2)) AS i
        FROM docs d JOIN (SELECT DISTINCT k FROM windows) s ON len(d.w) >= s.k
    )
),
found AS (
    SELECT DISTINCT r, i, k, item_id FROM runs JOIN windows USING (k, run)
),
marked AS (
    SELECT r, count(DISTINCT word) AS n_hit
    FROM (SELECT r, unnest(range(i, i + k)) AS word FROM found) GROUP BY r
),
listed AS (
    SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM found WHERE item_id IS NOT NULL)
    GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {COVERAGE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN marked USING (r) LEFT JOIN listed USING (r)
"""
