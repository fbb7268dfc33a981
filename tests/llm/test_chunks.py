"""Exact dedup by chunk recipes against a plain grouping of texts."""

from __future__ import annotations

import hashlib
import random
import string
from collections import Counter, defaultdict

from edges import edge_docs, no_docs, text_rows
from reportmill.llm import chunk_recipes as cr

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_groups(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(LOWER)].append(i)
    return groups


def check(found, rows):
    groups = plain_groups(rows)
    got = defaultdict(list)
    for r in found.collect():
        got[r["text_sha256"]].append(r)
    assert sum(map(len, got.values())) == len(rows)
    for text, ids in groups.items():
        mine = got.pop(hashlib.sha256(text.encode()).hexdigest())
        assert Counter(r["row_id"] for r in mine) == Counter(ids)
        largest = max((i for i in ids if i is not None), default=None)
        assert {(r["keep_id"], r["group_size"]) for r in mine} == {(largest, len(ids))}
        assert [r["row_id"] for r in mine if r["kept"]] == [largest]
    assert not got


def mixed_rows():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdE é\n") for _ in range(rng.choice([0, 1, 40, 700, 5_000, 40_000]))) for _ in range(60)]
    texts += [t.upper().replace("É", "é") for t in texts[:20]] + [t[:-1] + "~" for t in texts[:20] if t] + ["a" * 50_000, "A" * 50_000]
    return [(k, t) for k, t in enumerate(texts)] + [(None, texts[3]), (None, "only without id"), (5, texts[5])]


def test_copies_of_odd_rows(spark):
    check(cr.find_copies(edge_docs(spark)), text_rows())
    assert cr.find_copies(no_docs(spark)).count() == 0


def test_copies_of_mixed_rows(spark):
    rows = mixed_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    check(cr.find_copies(docs), rows)


def test_identifiers_that_clash_are_made_anew(spark):
    rows = mixed_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(cr.find_copies(docs, bits=8, map_bits=64), rows)


def test_a_third_of_the_rows_alike_and_string_ids(spark):
    rows = [(f"id{k:04d}", "the same text " * 200 if k % 3 else f"text {k}") for k in range(900)]
    check(cr.find_copies(spark.createDataFrame(rows, "doc_id string, text string").repartition(7)), rows)


def test_chunks_depend_on_the_text_alone():
    rng = random.Random(5)
    texts = [bytes(rng.choices(b"abcdefgh \n", k=n)) for n in (0, 10, 3_000, 60_000, 511, 512, 513)]
    together = cr.chunks_of(texts)
    assert [b"".join(c) for c in together] == texts
    assert together == [cr.chunks_of([t])[0] for t in texts]
    assert all(cr.LEAST <= len(c) <= cr.MOST for chunks in together for c in chunks[:-1])
    tail = cr.chunks_of([b"other start " * 100 + texts[3]])[0]
    assert len(set(tail) & set(together[3])) > len(together[3]) / 2


def test_keep_rows(spark):
    rows = mixed_rows()
    docs = spark.createDataFrame([(i, t, "k", "h") for i, t in rows], "doc_id bigint, text string, row_id string, key string")
    kept = cr.keep_rows(docs)
    assert kept.columns == docs.columns
    want = {t: max((i for i in ids if i is not None), default=None) for t, ids in plain_groups(rows).items()}
    assert Counter((r["doc_id"], r["text"].translate(LOWER)) for r in kept.collect()) == Counter((i, t) for t, i in want.items())
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c")], "doc_id bigint, text string")
    assert sorted(map(tuple, cr.keep_rows(twice).collect()), key=str) == [(1, "a"), (2, "b"), (None, "c")]
