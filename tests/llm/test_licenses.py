"""License scan: identifying words, disjoint copies, and templates read in blocks."""

from __future__ import annotations

from collections import Counter

from reportmill.llm import license_scan
from reportmill.llm.license_templates import all_templates

NOTICES = {
    "Released under the BSD License.": {"BSD-notice"},
    "Licensed under CC BY 4.0.": {"CC-BY-4.0-notice"},
    "Licensed under CC BY-NC 4.0.": {"CC-BY-NC-4.0-notice"},
    "This work is licensed under the GNU General Public License, version 2.": {"GPL-2.0-notice"},
    "This work is licensed under the GNU General Public License, version 3.": {"GPL-3.0-notice"},
    "This work is licensed under the GNU Lesser General Public License, version 3.": {"LGPL-3.0-notice"},
    "Licensed under the Apache License, Version 1.1.": {"Apache-1.1-notice"},
    "Licensed under the Apache License, Version 9.9.": set(),
    "Released under the Foo License.": set(),
    "SPDX-License-Identifier: MPL-2.0": {"MPL-2.0-spdx"},
}


def test_other_licenses_are_told_apart(spark):
    rows = [(k, f"Some words.\n{text}\nMore words.") for k, text in enumerate(NOTICES)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for k, (text, want) in enumerate(NOTICES.items()):
        assert {r["license"] for r in got if r["row_id"] == k} == want, text


def test_every_template_finds_itself_alone():
    scanner = license_scan.Scanner(all_templates(), license_scan.MIN_COVERAGE)
    for name, text, _ in all_templates():
        found = license_scan.disjoint(scanner(f"Some words before. {text} And words after it."))
        assert [m[0] for m in found] == [name]
    clauses = dict((n, t) for n, t, _ in all_templates() if n.startswith("BSD-") and n.endswith("Clause"))
    cut = clauses["BSD-3-Clause"].replace("Neither the name of", "Not even the name of")
    assert "BSD-3-Clause" not in {m[0] for m in scanner(cut)}


def test_every_disjoint_copy_is_found_for_any_number_of_blocks(spark):
    mit, short = license_scan.template_texts()["MIT"], "Released under the MIT License."
    rows = [(1, f"{short} Released the MIT License. Some text. {short}"), (2, f"{mit}\n{mit}\nand {short} {license_scan.template_texts()['Apache-2.0']}")]
    rows += [rows[0], (None, short), (None, short), (3, None), (4, license_scan.template_texts()["BSD-3-Clause"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in license_scan.scan(docs).collect())
    names = Counter((r[0], r[2]) for r in got.elements())
    assert names == {(1, "MIT-notice"): 6, (2, "MIT"): 2, (2, "MIT-notice"): 1, (2, "Apache-2.0"): 1, (None, "MIT-notice"): 2, (4, "BSD-3-Clause"): 1}
    assert sorted(tuple(r)[3:] for r in got if r[0] == 1) == [(4, 5, 5, 9), (5, 5, 0, 5), (5, 5, 11, 16)]
    table = license_scan.template_table(spark)
    for blocks in ({}, {"templates": table}, {"block_chars": 90_000}, {"templates": table, "block_chars": 90_000}):
        assert Counter(tuple(r) for r in license_scan.scan(docs, **blocks).collect()) == got


def test_templates_without_phrases():
    scanner = license_scan.Scanner([("a", "one two three four five one two", ())], 0.8)
    assert [m[:5] for m in scanner("x one two three four x five one two one two x four five one two")] == [("a", 7, 7, 1, 9), ("a", 6, 7, 9, 16)]
