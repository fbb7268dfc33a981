"""Spelling variants against a plain comparison of all words."""

from __future__ import annotations

import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest

from edges import edge_docs, no_docs, text_rows
from reportmill.llm import spelling

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def near(x: str, y: str) -> bool:
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    return len(y) == len(x) + 1 and any(y[:k] + y[k + 1 :] == x for k in range(len(y)))


def plain_variants(counts: dict[str, int], ratio: int = 5):
    forms, out = {}, {}
    links = {w: [v for v in counts if near(v, w)] for w in counts}
    for w, others in links.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (forms[w], root, counts[w], len(links[w]), counts[forms[w]] if forms[w] else None)
    return out


def rows_of(found):
    rows = found.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def random_words(rng, n):
    words = {"".join(rng.choices("aabcé", k=rng.randint(1, 9))) for _ in range(n)}
    return words | {"aaaaaaa", "aaaaaaaa", "aaaaaa", "x" * 3_000, "x" * 3_001, "x" * 1_500 + "y" + "x" * 1_499}


@pytest.mark.parametrize("limit", [2, 7, spelling.CELL])
def test_variants_match_all_comparisons(spark, limit):
    rng = random.Random(limit)
    counts = {w: rng.choice([1, 2, 5, 5, 30, 200, 1_000]) for w in random_words(rng, 500)}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(4)
    assert rows_of(spelling.variants(words, limit=limit)) == plain_variants(counts)


def test_scan_finds_all_pairs_of_its_cells():
    rng = random.Random(8)
    lists = [sorted({"".join(rng.choices("abc", k=rng.randint(0, 5))) for _ in range(rng.choice([1, 5, 80]))}) for _ in range(20)]
    middles = [w for words in lists for w in words]
    cell = np.repeat(np.arange(20), [len(words) for words in lists])
    asked, found = spelling.scan(middles, cell)
    got = Counter(zip(asked.tolist(), found.tolist(), strict=True))
    want = Counter((i, j) for i, x in enumerate(middles) for j, y in enumerate(middles) if cell[i] == cell[j] and near(x, y))
    assert got == want


def test_large_cells_are_dealt_again(spark):
    rng = random.Random(2)
    words = {"prefix" + "".join(rng.choices("abcd", k=6)) for _ in range(600)}
    table = spark.createDataFrame([(w, 9) for w in words], "word string, n bigint")
    cells = spelling.bounded_cells(table, 10)
    sizes = cells.groupBy(*spelling.CELL_KEY).count().collect()
    assert all(r["count"] <= 10 or r["m"] - r["a"] - r["b"] <= 1 for r in sizes)
    assert rows_of(spelling.variants(table, limit=10)) == plain_variants(dict.fromkeys(words, 9))


def plain_counts(rows, least=6, damage=None):
    counts = Counter()
    for i, text in rows:
        for run in re.findall(f"[{spelling.LETTERS}]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return Counter({w: n for w, n in counts.items() if len(w) >= least})


@pytest.mark.parametrize("damage", [None, 199, 3])
def test_counts_match_a_plain_count(spark, damage):
    rng = random.Random(1)
    rows = text_rows() + [(k, " ".join("".join(rng.choices("abÀÿß×", k=rng.randint(1, 9))) for _ in range(80))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["word"]: r["n"] for r in spelling.count_words(docs, damage=damage).collect()}
    assert got == plain_counts(rows, damage=damage)


def test_odd_tables(spark):
    assert {r["word"]: r["n"] for r in spelling.count_words(edge_docs(spark)).collect()} == plain_counts(text_rows())
    assert spelling.count_words(no_docs(spark)).count() == 0
    odd = [("word", 5, "x"), (None, 9, "x"), ("", 7, "x"), ("word", 2, "x"), ("work", None, "x"), ("wird", 1, "x")]
    table = spark.createDataFrame(odd, "word string, n bigint, middle string")
    assert rows_of(spelling.variants(table)) == plain_variants({"word": 7, "wird": 1})
    assert spelling.variants(table.limit(0)).count() == 0
