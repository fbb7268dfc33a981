"""The conversation trie against one built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from reportmill.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, d1 string, blk string, pos string"


def ordered(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    return {c: [(r, t) for _, _, r, _, t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    rows = []
    for path, ids in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        parents = {p[:-1] for p in below if p}
        ends = [c for c in ids if len(convs[c]) == len(path)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        rows.append((ids[0], len(path), members[path[:-1]][0] if path else None, len(ids), len(kids), sum(p not in parents for p in below), saved, digest))
    return Counter(rows)


def rows_of(found):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(tuple(r) for r in found.select(*names).collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, "w", "x", "y", "z") for r in rows], SCHEMA).repartition(4)


def random_rows(seed, n=60, longest=14):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randint(0, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "é", "", None])))
    rows += [(100, t, "user", "a") for t in range(30)] + [(101, t, "user", "a" if t < 29 else "b") for t in range(30)]
    # Repeated rows, ties, null turns, no id, negative ids.
    rows += rows[:5] + [(102, None, "user", "b"), (102, None, "user", "a"), (102, 0, None, None), (None, 0, "user", "a"), (-3, 1, "user", "a"), (-5, 1, "user", "b")]
    return rows


@pytest.mark.parametrize("block", [1, 3, 4])
def test_trie_matches_the_plain_one(spark, block):
    rows = random_rows(block)
    assert rows_of(pt.prefix_trie(table(spark, rows), block)) == plain_trie(ordered(rows))


def test_rebuilt_conversations(spark):
    rows = random_rows(9, 40)
    turns = table(spark, rows)
    convs = pt.conversations(turns)
    steps = pt.borrow_starts(pt.turn_steps(turns), convs)
    assert rows_of(pt.trie_of(steps, convs)) == plain_trie(rebuilt(ordered(rows)))


def test_a_conversation_with_most_rows(spark):
    rows = [(1, t, "user", f"turn {t % 7}") for t in range(400)] + [(2, t, "user", f"turn {t % 7}") for t in range(390)] + [(c, 0, "user", "turn 0") for c in range(3, 60)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(pt.prefix_trie(table(spark, rows))) == plain_trie(ordered(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_no_conversations(spark):
    assert pt.prefix_trie(table(spark, [(1, 1, "a", "b")]).limit(0)).count() == 0
    assert pt.prefix_trie(table(spark, [(None, 1, "a", "b")])).count() == 0
    assert rows_of(pt.prefix_trie(table(spark, [(7, None, None, None)]))) == plain_trie({7: [("", "")]})


def test_many_ends_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(pt, "PIECE", 20)
    rows = [(c, 0, "user", "same") for c in range(300)]
    assert rows_of(pt.prefix_trie(table(spark, rows))) == plain_trie(ordered(rows))
