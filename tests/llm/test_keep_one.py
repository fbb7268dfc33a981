"""Near duplicates of tables whose ids repeat or are null."""

from __future__ import annotations

from collections import Counter

from reportmill.llm import jaccard


def test_rows_that_share_an_id_or_have_none_are_told_apart(spark):
    text = lambda letter, n=60: " ".join(f"{letter}{k}" for k in range(n))
    rows = [
        (1, text("a")), (2, text("a")), (2, text("b")),  # the namesake of a copy stays
        (3, text("c")), (3, text("d")), (3, text("d")),  # both texts stay, the repeated row once
        (None, text("e")), (None, text("e") + " tail"), (None, text("f")),  # of near duplicates without an id one stays
        (None, text("a")), (4, text("d") + " tail"), (5, None), (6, ""), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = Counter((r["doc_id"], (r["text"] or "")[:1]) for r in jaccard.keep_one(docs).collect())
    assert kept == Counter([(1, "a"), (2, "b"), (3, "c"), (3, "d"), (None, "e"), (None, "f"), (5, ""), (6, ""), (None, "")])
