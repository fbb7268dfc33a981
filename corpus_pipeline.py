"""The document pipeline: five stages, each written as Parquet and read again as the input of the next.

1. Quality rules: documents that fail the base rules, or whose host is rejected, go.
2. N-gram Jaccard join, five-word shingles, similarity 0.8: of each component of near duplicates the document with the
   smallest id stays.
3. Benchmark decontamination: documents that hold a segment of a test item go.
4. Secret scan: every secret is replaced by a mark, and ``n_chars`` follows the text.
5. Byte-level BPE: token counts, and digests of the ids and of the text decoded from them.

Every stage works on all documents that its predecessor kept, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportmill.llm import bpe, decontaminate, jaccard, quality_rules, secret_scan
from reportmill.llm.common import read_table, rows_without, stored
from reportmill.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rows_without(docs, quality_rules.judge(docs).where("NOT kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rows_without(docs, decontaminate.find_leaks(docs, read_table(spark, sf_dir, "benchmark")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode(docs, tokenizer_path("byte_bpe_50k.json"), ("ids_sha256", "decoded_sha256"))
    return coded.select(F.col("row_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: Edit matching and BPE have no SQL form; tests compare ``run`` with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
