"""Links through rows without an id, ids of other types, long sets, and the bitmap of places."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportmill.llm import jaccard


def chain(n=200):
    """Three texts of which only neighbours are linked at 0.9."""
    words = [f"w{k}" for k in range(n)]
    step = n // 30
    return [" ".join([f"x{k}" for k in range(step * m)] + words[step * m :]) for m in (0, 1, 2)]


@pytest.mark.parametrize("middle", [None, 5])
def test_a_row_without_an_id_links_its_neighbours(spark, middle):
    a, b, c = chain()
    rows = [(1, a), (middle, b), (2, c), (7, "other words altogether here"), (None, "no id and no link at all")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = sorted((r["row_id"] or 0, r["component"] or 0) for r in jaccard.similar_components(docs, 3, 90, 100).collect())
    assert found == sorted([(1, 1), (middle or 0, 1), (2, 1), (7, 7), (0, 0)])


def test_text_ids(spark):
    a, b, c = chain()
    docs = spark.createDataFrame([("b", a), ("a", b), ("c", c), ("z", "something else than that")], "doc_id string, text string")
    found = {r["row_id"]: r["component"] for r in jaccard.similar_components(docs, 3, 90, 100).collect()}
    assert found == {"a": "a", "b": "a", "c": "a", "z": "z"}
    assert sorted(r["doc_id"] for r in jaccard.keep_one(docs, 3, 90, 100).collect()) == ["a", "z"]


def test_long_sets_and_large_counts(spark):
    words = [f"w{k}" for k in range(90_000)]
    texts = [" ".join(words), " ".join(words[:88_000] + [f"y{k}" for k in range(2_000)]), " ".join(f"z{k}" for k in range(90_000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["row_id"]: r["component"] for r in jaccard.similar_components(docs, 3, 90, 100).collect()}
    assert found == {0: 0, 1: 0, 2: 2}


def test_counts_keep_their_values():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 500, 200_000)]
    for group in (sets[:2], sets):
        stored = jaccard.stored_counts([jaccard.group_counts(s).tobytes() for s in group])
        assert stored.sum(axis=1, dtype=np.int64).tolist() == [len(s) for s in group]


def test_places_are_marked(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MAP_BITS", 128)
    texts = spark.range(-300, 300).select(F.col("id").alias("place"), F.lit("t").alias("text"))
    places = spark.createDataFrame([(-7,), (3,), (250,)], "place bigint")
    found = {r["place"] for r in jaccard.at_places(texts, places).collect()}
    assert found == {p for p in range(-300, 300) if p % 128 in {(-7) % 128, 3, 250 % 128}}
