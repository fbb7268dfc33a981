"""Quality rules judged by host: failures by host, rates shrunk with an empirical beta prior, verdicts joined back.

Null texts count as empty, and an empty text fails for its length. Rows without a host get no host verdict. Repeated
rows are judged alike and all count for their host. An empty table gives an empty result. Only the named columns of
the input are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportmill.llm.common import WORD, hinted, row_hash, stored, text_of

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: A rule's failures by documents; each is a condition on the measures.
RULES: dict[str, str] = {
    "short": f"n_words < {MIN_WORDS}",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "repeats": "100 * n_repeat_words > 50 * n_words",
}
BASE_RULES = ("short", "repeats")
#: A host whose shrunk failure rate of any rule is above this is rejected with all its documents.
MAX_HOST_RATE = 0.5
#: The prior counts as so many documents at least, and at most.
MIN_PRIOR, MAX_PRIOR = 1.0, 1_000_000.0
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def covered_by_repeats(words: str) -> dict[str, Column]:
    """Columns to add one after the other; the last one counts the words in three-word windows found twice or more.

    Windows are compared by 64-bit hashes. Only texts that have a repeated hash sort their windows.
    """
    empty = F.array().cast("array<struct<gram:bigint,at:int>>")
    window = lambda word, i: F.xxhash64(word, F.get(F.col(words), i + 1), F.get(F.col(words), i + 2))
    same = lambda item, i: item["gram"].eqNullSafe(F.get(F.col("sorted"), i)["gram"])
    return {
        "grams": F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), window),
        "sorted": F.when(
            F.size(F.array_distinct("grams")) < F.size("grams"),
            F.sort_array(F.transform("grams", lambda gram, i: F.struct(gram.alias("gram"), i.alias("at")))),
        ).otherwise(empty),
        "starts": F.sort_array(
            F.transform(F.filter("sorted", lambda item, i: same(item, i - 1) | same(item, i + 1)), lambda item: item["at"])
        ),
        "n_repeat_words": F.aggregate(
            F.transform("starts", lambda at, i: F.least(F.coalesce(F.get(F.col("starts"), i + 1) - at, F.lit(3)), F.lit(3))),
            F.lit(0).cast("bigint"),
            lambda total, n: total + n,
        ),
    }


def measure(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per document: ``row_id``, ``row_hash``, ``host`` and the measures."""
    text = F.col("text")
    read = docs.select(
        docs[id_col].alias("row_id"), row_hash(docs, id_col, text_col).alias("row_hash"), docs[host_col].alias("host"), text_of(docs, text_col).alias("text")
    )
    out = read.select(
        "row_id",
        "row_hash",
        "host",
        F.length(F.translate(text, WHITE, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)).alias("lines"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
    )
    for name, column in covered_by_repeats("words").items():
        out = out.withColumn(name, column)
    return out.select(
        "row_id",
        "row_hash",
        "host",
        F.size("words").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
    )


def host_verdicts(measured: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``host``, the shrunk failure rate of each rule, and ``rejected``.

    The prior of a rule is a beta distribution with the pooled rate as mean and, by moments, the spread of the hosts'
    rates around it.
    """
    failed = [F.sum(F.expr(rule).cast("bigint")).alias(f"failed_{name}") for name, rule in RULES.items()]
    hosts = measured.where("host IS NOT NULL").groupBy("host").agg(F.count("*").alias("docs"), *failed)
    sums = [F.sum("docs").alias("docs")]
    for name in RULES:
        f = F.col(f"failed_{name}")
        sums += [F.sum(f).alias(f"f_{name}"), F.sum(f.cast("double") * f / F.col("docs")).alias(f"q_{name}")]
    out = hosts.withColumn("all", hosts.agg(F.struct(*sums)).scalar())
    for name in RULES:
        mean = F.col(f"all.f_{name}") / F.col("all.docs")
        spread = F.col(f"all.q_{name}") / F.col("all.docs") - mean * mean
        strength = F.when(spread > 0, F.greatest(F.lit(MIN_PRIOR), F.least(F.lit(MAX_PRIOR), mean * (1 - mean) / spread - 1))).otherwise(F.lit(MAX_PRIOR))
        out = out.withColumn(f"rate_{name}", (F.col(f"failed_{name}") + mean * strength) / (F.col("docs") + strength))
    return out.select("host", "docs", *[f"rate_{n}" for n in RULES], (F.greatest(*[F.col(f"rate_{n}") for n in RULES]) > max_rate).alias("rejected"))


def judge(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per document: ``row_id``, ``row_hash``, ``host``, the measures, ``base_failed``, ``host_rejected``, ``kept``."""
    measured = stored(measure(docs, id_col, host_col, text_col))
    # Only rejected hosts are joined, and stored, so that a host with very many documents can be split.
    verdicts = hinted(stored(host_verdicts(measured, max_rate).where("rejected").select("host", "rejected")))
    base = F.expr(" OR ".join(RULES[name] for name in BASE_RULES))
    return (
        measured.join(verdicts, "host", "left")
        .withColumn("base_failed", base)
        .withColumn("host_rejected", F.coalesce("rejected", F.lit(False)))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .drop("rejected")
    )
