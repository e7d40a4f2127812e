"""License scans against comparing every unit with every template in plain Python."""

import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from termpeak.llm.license_scan import (
    TEMPLATES,
    scan_licenses,
    size_range,
    telling_words,
    template_bigrams,
    template_words,
)

MIT = dict((n, t) for n, t in TEMPLATES if len(t) > 200)["MIT"]


def units_of(text):
    for k, line in enumerate(text.split("\n")):
        yield "line", k, line
    parts = re.split(r"\n[ \t\r]*\n", text)
    for k, part in enumerate(parts):
        if "\n" in part:
            yield "paragraph", k, part
    if len(parts) > 1:
        yield "document", 0, text


def brute(rows, threshold=0.8):
    out = []
    for doc_id, text in rows:
        for unit, place, own in units_of(text or ""):
            a = set(template_bigrams(own))
            for k, (name, template) in enumerate(TEMPLATES):
                b = set(template_bigrams(template))
                must, not_ = telling_words(name, template)
                own_words = set(template_words(own))
                if not set(must) <= own_words or set(not_) & own_words:
                    continue
                if a and 2 * len(a & b) / (len(a) + len(b)) >= threshold:
                    out.append((doc_id, unit, place, k, name, len(a), len(b), len(a & b)))
    return sorted(out, key=str)


def found(docs):
    return sorted((tuple(r)[:8] for r in scan_licenses(docs).collect()), key=str)


def test_whole_small_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    assert found(docs) == brute(rows) != []


def test_licenses_inside_texts_and_odd_rows(spark):
    lines = re.sub(r"(?<=[.,]) ", "\n", MIT)
    rows = [
        (1, MIT), (2, f"Some title\n\n{lines}\n \nand then code"), (3, "Header\n\n" + lines.replace("Software", "Program")),
        (4, None), (5, ""), (6, "word"), (7, "Released under\tthe MIT-License!!"), (7, "Released under\tthe MIT-License!!"),
        (None, "© 2020 É\nall RIGHTS reserved"), (8, "the " * 30000), (9, "Released under the WTF License\n\n\n"),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, license string")
    assert found(docs) == brute(rows)
    by_id = {r[0] for r in found(docs)}
    assert {1, 2, 7, None} <= by_id and not by_id & {4, 5, 6, 8}
    assert scan_licenses(docs.limit(0)).count() == 0


@given(st.integers(1, 400), st.integers(1, 400), st.sampled_from([0.5, 0.8, 0.95]))
def test_sizes_out_of_range_cannot_match(n, m, threshold):
    low, high = size_range(n, threshold)
    if not low <= m <= high:
        assert 2 * min(n, m) / (n + m) < threshold + 1e-9


def test_too_many_templates(spark):
    with pytest.raises(ValueError):
        scan_licenses(spark.range(1).selectExpr("id doc_id", "'' text"), [("x", "a " * 200_001)])


GNU = next(t for n, t in TEMPLATES if n == "GPL-3.0-or-later")
BSD = dict(TEMPLATES)["BSD-3-Clause"]
NAMED = [
    ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0-only"}),
    ("This work is licensed under the GNU General Public License, version 3.", {"GPL-3.0-only"}),
    (GNU, {"GPL-3.0-or-later"}),
    (GNU.replace("General", "Affero General"), {"AGPL-3.0-or-later"}),
    (GNU.replace("General", "Lesser General"), {"LGPL-3.0-or-later"}),
    (GNU.replace("version 3", "version 2"), {"GPL-2.0-or-later"}),
    (BSD, {"BSD-3-Clause"}),
    (BSD.replace("the copyright holder nor", "the University nor"), {"BSD-3-Clause"}),
    (dict(t for t in TEMPLATES if t[0] == "BSD-2-Clause")["BSD-2-Clause"], {"BSD-2-Clause"}),
    ("Licensed under CC BY 3.0.", {"CC-BY-3.0"}),
    ("Licensed under CC BY 4.0.", {"CC-BY-4.0"}),
    ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", {"CC-BY-3.0"}),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", {"CC-BY-ND-4.0"}),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", {"CC-BY-NC-SA-4.0"}),
    ("Licensed under CC BY-NC 4.0.", {"CC-BY-NC-4.0"}),
    ("Licensed under CC BY 2.5.", set()),
]


def test_variants_get_their_own_name(spark):
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(NAMED)], "doc_id long, text string")
    named = {k: set() for k in range(len(NAMED))}
    for row in scan_licenses(docs).collect():
        named[row["doc_id"]].add(row["license"])
    assert named == {k: names for k, (_, names) in enumerate(NAMED)}
