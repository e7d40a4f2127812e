"""Strict reading of one JSON document record.

A record is one JSON object, and nothing else, with ``filename`` and ``content``
as JSON strings. Other fields are ignored; of a repeated field the last counts.
Spark's JSON reader alone is laxer: it turns a missing field into null, takes a
number or an object as text, skips blank lines and ignores what follows the
first value. The expressions here close those gaps.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column
from pyspark.sql import functions as F

from termpeak.functions.binding import let

# Spark's own limit on a variant value. No field of a shorter line can reach it.
VARIANT_LIMIT = 128 * 1024 * 1024

# The line is parsed as `[<line>,{"<mark>":true}]`. Only if the line is one whole
# JSON value does the array have two elements, the second carrying the mark: text
# after the object either breaks the array or closes it before the mark is read.
# The mark is new in each driver process so that no input can contain it.
_MARK = "end_" + uuid4().hex

# No limit of the parser's own on strings. Numbers and nesting stop at lengths far
# beyond any record meant to be read; the time to read a number grows with the
# square of its digits, and each level of nesting holds memory.
_OPTIONS = {
    "mode": "PERMISSIVE",
    "allowSingleQuotes": "false",
    "maxStringLen": "2147483647",
    "maxNumLen": "1000000",
    "maxNestingDepth": "20000",
}


def line_text(value: Column) -> Column:
    """Bytes of a line as text: UTF-8 where they are valid UTF-8, else Latin-1."""
    return F.coalesce(
        F.try_validate_utf8(value), F.decode(value.cast("binary"), "ISO-8859-1")
    )


def document(line: Column) -> Column:
    """``struct<filename, content>`` of a line that is a record, null of any other."""
    return F.when(F.octet_length(line) < VARIANT_LIMIT, _short_document(line)).otherwise(
        _long_document(line)
    )


def _parse(line: Column, field_type: str) -> Column:
    """The marked line, its two fields read as the given type."""
    schema = f"array<struct<filename:{field_type},content:{field_type},{_MARK}:boolean>>"
    return F.from_json(
        F.concat(F.lit("["), line, F.lit(f',{{"{_MARK}":true}}]')), schema, _OPTIONS
    )


def _is_whole(parsed: Column) -> Column:
    return (F.size(parsed) == 2) & F.get(parsed, F.lit(1))[_MARK]


def _is_string(variant: Column) -> Column:
    return F.schema_of_variant(variant) == "STRING"


def _short_document(line: Column) -> Column:
    """One pass of the parser: a variant keeps the JSON type of each field."""

    def checked(parsed: Column) -> Column:
        record = F.get(parsed, F.lit(0))
        filename, content = record["filename"], record["content"]
        return F.when(
            _is_whole(parsed) & _is_string(filename) & _is_string(content),
            F.struct(
                F.try_variant_get(filename, "$", "string").alias("filename"),
                F.try_variant_get(content, "$", "string").alias("content"),
            ),
        )

    return let(_parse(line, "variant"), checked)


def _long_document(line: Column) -> Column:
    """The same for lines of any length, at several passes.

    A field too long for a variant is null as one. It is a string if it can be
    read as text, which anything can, but not as an object or an array.
    """
    types = ("variant", "string", "map<string,string>", "array<string>")
    parses = F.struct(*(_parse(line, t).alias(f"p{i}") for i, t in enumerate(types)))

    def checked(parsed: Column) -> Column:
        variant, text, *others = (
            F.get(parsed[f"p{i}"], F.lit(0)) for i in range(len(types))
        )

        def is_string(field: str) -> Column:
            verdict = text[field].isNotNull()
            for other in others:
                verdict &= other[field].isNull()
            return F.coalesce(_is_string(variant[field]), verdict)

        return F.when(
            _is_whole(parsed["p1"]) & is_string("filename") & is_string("content"),
            F.struct(text["filename"].alias("filename"), text["content"].alias("content")),
        )

    return let(parses, checked)
