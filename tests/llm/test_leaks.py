"""Decontamination: the same rows for any number of blocks, short items, and items without an id."""

from __future__ import annotations

from collections import Counter

import pytest

from reportmill.llm import decontaminate


@pytest.mark.parametrize("block_chars", [10_000_000, 60])
def test_leaks_are_the_same_for_any_number_of_blocks(spark, block_chars):
    long, other = "the quick brown fox jumps over the lazy dog again", "pack my box with five dozen liquor jugs today"
    near = other.replace("five", "fine")
    items = [(1, long), (2, "Nine  lives"), (None, other), (None, "zig zag"), (3, near), (3, other), (4, ""), (5, None), (6, long)]
    docs = [(10, f"so {long} it is"), (10, f"so {long} it is"), (None, f"so {other}."), (None, f"so {other}."), (11, "it has NINE\nlives, yes")]
    docs += [(12, "canine lives on"), (13, "nine livestock"), (14, "a zig zag"), (15, None), (16, "")]
    found = decontaminate.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_chars=block_chars
    )
    got = Counter((r["row_id"], tuple(map(tuple, r["leaks"]))) for r in found.collect())
    assert got == {(10, ((1, 0), (6, 0))): 2, (None, ((None, 0), (3, 0))): 2, (11, ((2, 0),)): 1, (14, ((None, 0),)): 1}
