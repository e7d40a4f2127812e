"""Text expressions: normalise, split into words, count words within one value.

Everything here is a built-in JVM expression; nothing leaves the executor's JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from termpeak.functions.binding import let

# Fixed value: what normalising deletes. Deleted, not replaced by a space, so
# words on both sides of a newline, a tab or an apostrophe are glued together.
# The trailing + only makes the regex take a run of such characters at a time.
DELETED = "[^a-z ]+"


def normalize(content: Column) -> Column:
    """Lower-case first, then delete every character but a-z and the space."""
    return F.regexp_replace(F.lower(content), DELETED, "")


def words(content: Column) -> Column:
    """The words of a text in order, one per space; runs of spaces give ``''``."""
    return F.split(normalize(content), " ")


# Bytes of text whose words are laid out at a time, and how many such pieces' counts
# are added up at a time.
PIECE = 1 << 20
BATCH = 32


def term_counts(content: Column, piece: int = PIECE, batch: int = BATCH) -> Column:
    """``array<struct<word, n>>``: each distinct word of one text and its count.

    The count of a word within a record depends on that record alone, so it is
    taken inside the row: sort the words, find where runs of equal words end,
    and subtract neighbouring ends. That is O(m log m) for m words and needs no
    shuffle, whereas exploding first and grouping by (record, word) sends
    nearly every token of the collection over the network.

    A text of more than ``piece`` bytes is cut at spaces into pieces of about that
    size, which are counted one after the other; the counts of ``batch`` pieces at a
    time are added to those so far. So its words are never laid out all at once: what
    is held is the text, its distinct words, and those of the pieces of one batch.
    """

    def counts(text: Column) -> Column:
        return let(F.sort_array(words(text)), _runs)

    def added(so_far: Column, some: Column) -> Column:
        first = (F.size(so_far) == 0) & (F.size(some) == 1)  # all of a text of one piece
        every = F.concat(so_far, F.flatten(some))
        return F.when(first, F.get(some, F.lit(0))).otherwise(_sums(every))

    nothing = F.array().cast("array<struct<word:string,n:bigint>>")
    whole = F.octet_length(content) <= piece
    counted = let(
        F.when(whole, F.array(content)).otherwise(text_pieces(content, piece)),
        lambda pieces: F.aggregate(
            F.sequence(F.lit(1), F.size(pieces), F.lit(batch)),
            nothing,
            lambda so_far, k: let(
                F.transform(F.slice(pieces, k, F.lit(batch)), counts),
                lambda some: added(so_far, some),
            ),
        ),
    )
    return F.when(content.isNotNull(), counted)


def text_pieces(content: Column, piece: int = PIECE) -> Column:
    """The text cut after the first space of every ``piece`` bytes, in order.

    A stretch of ``piece`` bytes without a space is not cut. A space is a byte of its
    own in UTF-8 and no part of a word, so no character or word is ever cut.
    """
    raw = content.cast("binary")

    def cut(k: Column) -> Column:
        # one character to a byte, so that places are counted in bytes
        stretch = F.decode(F.substring(raw, k * piece + 1, F.lit(piece)), "ISO-8859-1")
        return let(F.instr(stretch, " "), lambda at: F.when(at > 0, k * piece + at))

    size = F.octet_length(content)
    inner = F.transform(F.sequence(F.lit(1), F.ceil(size / piece).cast("int") - 1), cut)
    inner = F.when(size > piece, inner).otherwise(F.array().cast("array<int>"))
    cuts = F.concat(F.array(F.lit(0)), F.array_compact(inner), F.array(size))

    def part(ends: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(ends) - 2),
            lambda k: F.substring(
                raw, F.get(ends, k) + 1, F.get(ends, k + 1) - F.get(ends, k)
            ).cast("string"),
        )

    return F.when(content.isNotNull(), let(cuts, part))


def _ends(ordered: Column, of: Callable[[Column], Column] = lambda x: x) -> Column:
    """The places, from 1, where runs of equal elements end."""
    return F.filter(
        F.sequence(F.lit(1), F.size(ordered)),
        # get() is null past the last one, which makes it a run's end
        lambda i: ~of(F.get(ordered, i - 1)).eqNullSafe(of(F.get(ordered, i))),
    )


def _runs(ordered: Column) -> Column:
    """Each distinct word of sorted words and how often it stands there."""
    return let(
        _ends(ordered),
        lambda found: F.transform(
            found,
            lambda end, k: F.struct(
                F.get(ordered, end - 1).alias("word"),
                (end - F.coalesce(F.get(found, k - 1), F.lit(0))).cast("bigint").alias("n"),
            ),
        ),
    )


def _sums(counted: Column) -> Column:
    """Each distinct word of ``array<struct<word, n>>`` and the sum of its counts."""

    def summed(ordered: Column) -> Column:
        def total(start: Column, end: Column) -> Column:
            return F.aggregate(
                F.slice(ordered, start + 1, end - start),
                F.lit(0).cast("bigint"),
                lambda sum_, one: sum_ + one["n"],
            )

        return let(
            _ends(ordered, lambda one: one["word"]),
            lambda found: F.transform(
                found,
                lambda end, k: F.struct(
                    F.get(ordered, end - 1)["word"].alias("word"),
                    total(F.coalesce(F.get(found, k - 1), F.lit(0)), end).alias("n"),
                ),
            ),
        )

    # not sort_array: only texts of several pieces come here, a text's words do not
    return let(
        F.array_sort(counted),
        lambda ordered: F.when(F.size(ordered) == 0, ordered).otherwise(summed(ordered)),
    )
