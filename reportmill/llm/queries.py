"""The registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportmill.llm import bpe, chunk_recipes, decontaminate, jaccard, license_scan, prefix_trie, quality_rules, secret_scan, sharding, spelling, substrings, token_counts, toxicity
from reportmill.llm.common import read_table
from reportmill.llm.sql import SQL

SHARDS = 8


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies; ``TOKENIZER_DIR`` names another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_count_tree_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_components(read_table(spark, sf_dir, "documents"), width=3, num=90, den=100)
    return found.select(F.col("row_id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op8_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents")).select(
        F.col("row_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("row_id").alias("doc_id"), "license", "matched", "template_words", "first_word", "end_word")


def op10_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return secret_scan.scan(read_table(spark, sf_dir, "documents")).select(
        F.col("row_id").alias("doc_id"),
        kind(0).alias("n_assign"),
        kind(1).alias("n_access"),
        kind(2).alias("n_hex"),
        F.sha2(secret_scan.named("base"), 256).alias("base_sha256"),
        secret_scan.named("spans").alias("spans"),
        "n_live",
        "n_example",
    )


def op1_pigeonhole_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    ids = F.transform("leaks", lambda leak: leak["item_id"])
    return found.select(
        F.col("row_id").alias("doc_id"), F.lit(True).alias("contaminated"), F.size("leaks").cast("bigint").alias("n_items"), ids.alias("item_ids")
    )


def op2_bpe_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), ("ids_sha256", "decoded_sha256"))
    return coded.select(F.col("row_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


def op3_lyndon_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(read_table(spark, sf_dir, "documents"), keep_text=False)
    return found.select(F.col("row_id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


def op4_bigru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 4 == 2, F.lit(False))
    labels = read_table(spark, sf_dir, "labels").where(~held_out)
    scored = toxicity.score(read_table(spark, sf_dir, "documents"), labels).withColumnRenamed("row_id", "doc_id")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return counted.select(F.col("row_id").alias("doc_id"), "n_words", "n_tokens")


def op6_bounded_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read_table(spark, sf_dir, "documents"), SHARDS).select(
        F.col("row_id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_banded_list_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = spelling.count_words(read_table(spark, sf_dir, "documents"), damage=199)
    return spelling.variants(counted.where("n >= 5"))


def op12_block_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    convs = prefix_trie.conversations(turns)
    return prefix_trie.trie_of(prefix_trie.borrow_starts(prefix_trie.turn_steps(turns), convs), convs)


def op13_chunk_recipe_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunk_recipes.find_copies(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("row_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pigeonhole_leaks": op1_pigeonhole_leaks,
    "op2_bpe_merge_rounds": op2_bpe_merge_rounds,
    "op3_lyndon_suffix_dedup": op3_lyndon_suffix_dedup,
    "op4_bigru_toxicity": op4_bigru_toxicity,
    "op5_trie_token_counts": op5_trie_token_counts,
    "op6_bounded_ring_shards": op6_bounded_ring_shards,
    "op7_count_tree_jaccard": op7_count_tree_jaccard,
    "op8_host_quality_rules": op8_host_quality_rules,
    "op9_patience_licenses": op9_patience_licenses,
    "op10_secret_ownership": op10_secret_ownership,
    "op11_banded_list_variants": op11_banded_list_variants,
    "op12_block_prefix_trie": op12_block_prefix_trie,
    "op13_chunk_recipe_dedup": op13_chunk_recipe_dedup,
}
ORACLE: dict[str, str] = {name: sql for name, sql in SQL.items() if name in QUERIES}
