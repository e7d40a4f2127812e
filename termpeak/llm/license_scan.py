"""License scans by the Dice coefficient over word bigrams, in DataFrame functions only.

Method. A unit of text is lower-cased and reduced to words; its set of word bigrams
is compared with that of every template whose size allows the threshold. For a Dice
coefficient of ``t`` the smaller set must have at least ``t / (2 - t)`` of the larger
one's size, so most templates are passed over by their size alone. Licenses of one family
differ in a few words only, which Dice hardly notices: a version, ``affero``, ``neither``. So
a unit must also have the telling words of the template, and none of its family's others.

Units are the lines of a document, its paragraphs of several lines, and the document
itself if it has several paragraphs; so a notice of one line, a license pasted into
a text, and a document that is one license are all found.

Scale. One scan and nothing else: each unit is compared where it is read. The
templates are part of the expression; their number and size are checked.

Defined results: one row for each unit and template at or above the threshold, none
for a text without any; null and empty texts have no words; units of one word have
no bigrams and match nothing. Repeated rows give repeated rows.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpeak.functions.binding import let

THRESHOLD = 0.8
MAX_TEMPLATE_WORDS = 200_000  # in all templates together
_NO_WORD = "[^a-z0-9\\x{80}-\\x{10FFFF}]+"
_BREAK = "\\n[ \\t\\r]*\\n"

# Parts that public license notices of one family share.
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: 1. Redistributions of source "
    "code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used "
    "to endorse or promote products derived from this software without specific prior written "
    "permission. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS '
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
    "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_COMMONS = [
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
]


def _gnu_notice(kind: str, version: str) -> str:
    name = f"GNU {kind}General Public License"
    return (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        f"of the {name} as published by the Free Software Foundation, either version {version} of "
        "the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        f"{name} for more details. You should have received a copy of the {name} along with this "
        "program. If not, see <https://www.gnu.org/licenses/>."
    )


# Public license notices and short license texts, by SPDX identifier.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        'to in writing, software distributed under the License is distributed on an "AS IS" '
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        'all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", '
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        'permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
        "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
        'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS "
        "FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
        "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
        "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
        "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details. You should have received a copy of the GNU "
        "General Public License along with this program. If not, see "
        "<https://www.gnu.org/licenses/>.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free "
        "to copy, modify, publish, use, compile, sell, or distribute this software, either in "
        "source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
    ("BSD-3-Clause", _BSD_START + _BSD_NAMES + _BSD_END),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-or-later", _gnu_notice("", "2")),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0-or-later", _gnu_notice("Affero ", "3")),
    ("LGPL-2.1-only", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1-or-later", _gnu_notice("Lesser ", "2.1").replace("program", "library").replace("Program", "Library")),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0-or-later", _gnu_notice("Lesser ", "3")),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the "
     "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    *(
        row
        for version, port in (("3.0", "Unported"), ("4.0", "International"))
        for letters, name in _COMMONS
        if (version, letters) not in {("4.0", "BY"), ("4.0", "BY-SA"), ("4.0", "BY-NC")}
        for row in (
            (f"CC-{letters}-{version}", f"Licensed under CC {letters} {version}."),
            (f"CC-{letters}-{version}", "This work is licensed under a Creative Commons "
             f"{name} {version} {port} License."),
        )
    ),
]

# Words that tell licenses of one family apart. A unit that matches a template must have
# those of them that the template has, and none of its family that the template has not.
_FAMILIES = [
    ("GPL", ["affero", "lesser", "2", "3"]),
    ("CC-", ["sa", "sharealike", "nc", "noncommercial", "nd", "noderivatives", "noderivs", "3", "4"]),
    ("BSD-", ["neither"]),
    ("Apache-", ["2"]),
    ("MPL-", ["2"]),
    ("EPL-", ["2"]),
]


def telling_words(name: str, text: str) -> tuple[list[str], list[str]]:
    """The words that a unit must have to be called by this license, and must not have."""
    own = set(template_words(text))
    for family, words_ in _FAMILIES:
        if family in name:
            return [w for w in words_ if w in own], [w for w in words_ if w not in own]
    return [], []


def template_words(text: str) -> list[str]:
    return re.sub("[^a-z0-9\x80-\U0010ffff]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def size_range(n: int, threshold: float) -> tuple[int, int]:
    """Least and most bigrams of a unit that can reach the threshold with ``n``."""
    ratio = threshold / (2 - threshold)
    return int(-(-n * ratio // 1)) if n else 0, int(n / ratio + 1e-9)


def _template_array(templates: list[tuple[str, str]], threshold: float) -> Column:
    total = sum(len(template_words(text)) for _, text in templates)
    if total > MAX_TEMPLATE_WORDS:
        raise ValueError(f"{total} words of templates; at most {MAX_TEMPLATE_WORDS}")
    rows = []
    for k, (name, text) in enumerate(templates):
        bigrams = template_bigrams(text)
        low, high = size_range(len(bigrams), threshold)
        # a margin of one, since the threshold itself decides afterwards
        must, not_ = telling_words(name, text)
        rows.append(
            {"k": k, "name": name, "b": bigrams, "low": max(1, low - 1), "high": high + 1}
            | {"must": must, "not": not_}
        )
    kind = (
        "array<struct<k:int,name:string,b:array<string>,low:int,high:int,"
        "must:array<string>,not:array<string>>>"
    )
    return F.from_json(F.lit(json.dumps(rows)), kind)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), _NO_WORD, " "), " "), "")


def bigrams(own: Column) -> Column:
    """The distinct bigrams of an array of words; empty for one word or none."""
    following = F.slice(own, F.lit(2), F.greatest(F.size(own) - 1, F.lit(0)))
    pairs = F.zip_with(
        F.slice(own, F.lit(1), F.greatest(F.size(own) - 1, F.lit(0))),
        following,
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.array_distinct(pairs)


def _matches(unit: Column, templates: Column, threshold: float) -> Column:
    """``array<struct<template, license, n_unit, n_template, n_shared>>`` of a unit."""

    def compare(own: Column, pairs: Column) -> Column:
        n = F.size(pairs)

        def tells(t: Column) -> Column:
            return (F.size(F.array_except(t["must"], own)) == 0) & ~F.arrays_overlap(t["not"], own)

        fitting = F.filter(templates, lambda t: (n >= t["low"]) & (n <= t["high"]))
        compared = F.transform(
            fitting,
            lambda t: F.struct(
                t["k"].alias("template"),
                t["name"].alias("license"),
                n.alias("n_unit"),
                F.size(t["b"]).alias("n_template"),
                F.size(F.array_intersect(pairs, t["b"])).alias("n_shared"),
                t["must"].alias("must"),
                t["not"].alias("not"),
            ),
        )
        return F.filter(
            compared,
            lambda m: (
                F.lit(2.0) * m["n_shared"] / (m["n_unit"] + m["n_template"]) >= F.lit(threshold)
            )
            & tells(m),
        )

    return let(words(unit), lambda own: let(bigrams(own), lambda pairs: compare(own, pairs)))


def scan_licenses(
    docs: DataFrame,
    templates: list[tuple[str, str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id``, ``unit``, ``place``, ``template``, ``license``, sizes and ``dice``."""
    known = TEMPLATES if templates is None else templates
    array = _template_array(known, threshold)
    parts = F.split("text", _BREAK)
    units = {
        "line": F.split("text", "\n"),
        "paragraph": F.transform(parts, lambda p: F.when(F.contains(p, F.lit("\n")), p)),
        "document": F.when(F.size(parts) > 1, F.array("text")),
    }

    def matches(name: str, own: Column) -> Column:
        def of(unit: Column, place: Column) -> Column:
            return F.transform(
                _matches(F.coalesce(unit, F.lit("")), array, threshold),
                lambda m: F.struct(F.lit(name).alias("unit"), place.alias("place"), m.alias("m")),
            )

        return F.flatten(F.transform(F.coalesce(own, F.array().cast("array<string>")), of))

    found = F.flatten(F.array(*(matches(name, own) for name, own in units.items())))
    rows = docs.select("doc_id", F.explode(found).alias("f"))
    return rows.select(
        "doc_id",
        "f.unit",
        "f.place",
        "f.m.template",
        "f.m.license",
        "f.m.n_unit",
        "f.m.n_template",
        "f.m.n_shared",
        (F.lit(2.0) * F.col("f.m.n_shared") / (F.col("f.m.n_unit") + F.col("f.m.n_template"))).alias("dice"),
    )


def license_query(docs: DataFrame) -> DataFrame:
    return scan_licenses(docs)


def license_sql() -> str:
    def listed(values: list[str]) -> str:
        return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]::VARCHAR[]"

    quoted = ", ".join(
        f"({k}, '{name}', {listed(template_bigrams(text))}, "
        + ", ".join(map(listed, telling_words(name, text)))
        + ")"
        for k, (name, text) in enumerate(TEMPLATES)
    )
    return f"""
WITH templates(template, license, b, must, must_not) AS (VALUES {quoted}),
texts AS (
    SELECT row_number() OVER () AS r, doc_id, text,
           string_split_regex(text, '\\n[ \\t\\r]*\\n') AS parts
    FROM documents WHERE text IS NOT NULL
),
units AS (
    SELECT r, doc_id, 'line' AS unit, unnest(range(len(l))) AS place, unnest(l) AS u
    FROM (SELECT r, doc_id, string_split(text, chr(10)) AS l FROM texts)
    UNION ALL
    SELECT * FROM (
        SELECT r, doc_id, 'paragraph' AS unit, unnest(range(len(parts))) AS place, unnest(parts) AS u
        FROM texts
    ) WHERE contains(u, chr(10))
    UNION ALL
    SELECT r, doc_id, 'document', 0, text FROM texts WHERE len(parts) > 1
),
tokens AS (
    SELECT r, doc_id, unit, place, list_filter(string_split(
        regexp_replace(lower(u), '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'), ' '), lambda w: w <> '') AS w
    FROM units
),
sets AS (
    SELECT r, doc_id, unit, place, w,
           list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS b
    FROM tokens WHERE len(w) > 1
)
SELECT s.doc_id, s.unit, CAST(s.place AS INTEGER) AS place, t.template, t.license,
       CAST(len(s.b) AS INTEGER) AS n_unit, CAST(len(t.b) AS INTEGER) AS n_template,
       CAST(len(list_intersect(s.b, t.b)) AS INTEGER) AS n_shared,
       2.0::DOUBLE * len(list_intersect(s.b, t.b)) / (len(s.b) + len(t.b)) AS dice
FROM sets s JOIN templates t
ON 3 * len(s.b) >= 2 * len(t.b) AND 3 * len(t.b) >= 2 * len(s.b)
WHERE 2.0::DOUBLE * len(list_intersect(s.b, t.b)) / (len(s.b) + len(t.b)) >= 0.8::DOUBLE
  AND list_has_all(s.w, t.must) AND NOT list_has_any(s.w, t.must_not)
"""
