"""The pipeline drops all documents of a host that a rule outside the base rules rejects."""

from __future__ import annotations

import random

import corpus_pipeline
from reportmill.llm import quality_rules


def test_pipeline_drops_a_bad_host(spark, tmp_path):
    rng = random.Random(7)
    text = lambda: " ".join("".join(rng.choice("aeiourstlnm") for _ in range(7)) for _ in range(60))
    rows = [(k, text(), "en", "good") for k in range(30)]
    rows += [(100 + k, text() + " # * $" * 9, "en", "bad") for k in range(30)] + [(200 + k, text(), "en", "bad") for k in range(5)]
    rows += [(300, text() + " # * $" * 9, "en", "good"), (301, text(), "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "cast(length(text) as bigint) AS n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "no document holds this benchmark item at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert quality_rules.judge(docs).where("base_failed").count() == 0
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()}
    assert got == {*range(30), 300, 301}
