"""Secret scan with corpus-wide ownership: spans by pattern, candidate values counted by distinct repositories and owners.

A value that few owners hold looks live; one that many owners hold is a copied example. Positions are code points, the
end exclusive. Null texts count as empty. A null owner or repository counts as one more value. Repeated rows count once.
An empty table gives an empty result. Only the named columns of the input are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportmill.llm.common import hinted, row_hash, stored, text_of

#: Kind, pattern, group that holds the secret, smallest length of that group. In the order of the kinds.
KINDS: tuple[tuple[str, str, int, int], ...] = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: What the ownership count judges besides: long tokens that mix letters and digits.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
MIN_DISTINCT = 10
LIVE = "live"
#: A value looks live if at most so many owners hold it.
MAX_OWNERS = 2
#: A live value stands in so many documents (repositories) of its owners at most.
MAX_REPOS = 20
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"
MARK = "[SECRET]"


def spans_of(text: Column, pattern: str, group: int, kind: int) -> Column:
    """All matches of a pattern, left to right: what stands between them gives their positions."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), 1, F.size(whole)).alias("before"),
        whole.alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["before"])
        end = begin + F.length(part["found"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), part["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    spans = F.aggregate(parts, start, step, lambda state: state["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def long_enough(spans: Column, least: int) -> Column:
    return F.filter(spans, lambda s: F.length(s["value"]) >= least)


def mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= MIN_DISTINCT)


def find_spans(docs: DataFrame, id_col: str = "doc_id", owner_col: str = "source", repo_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row_id``, ``row_hash``, ``owner``, ``repo``, ``base`` spans and other ``tokens`` of every document."""
    read = docs.select(
        docs[id_col].alias("row_id"),
        row_hash(docs, id_col, text_col).alias("row_hash"),
        docs[owner_col].cast("string").alias("owner"),
        docs[repo_col].cast("string").alias("repo"),
        text_of(docs, text_col).alias("text"),
    )
    text = F.col("text")
    kinds = [long_enough(spans_of(text, pattern, group, kind), least) for kind, (_, pattern, group, least) in enumerate(KINDS)]
    found = read.select(
        "row_id",
        "row_hash",
        "owner",
        "repo",
        F.sort_array(F.concat(*kinds)).alias("base"),
        F.filter(spans_of(text, TOKEN, 0, len(KINDS)), lambda s: mixed(s["value"])).alias("tokens"),
    )
    # A token that a base span covers is marked already; one that reaches beyond it is judged as a whole.
    beyond = lambda t: ~F.exists("base", lambda b: (b["start"] <= t["start"]) & (b["end"] >= t["end"]))
    return found.withColumn("tokens", F.filter("tokens", beyond))


def ownership(candidates: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """``secret`` (a hash), ``owners``, ``repos`` and ``live``; ``candidates`` has secret, owner and repo.

    A value of many owners is an example, and so is one that few owners have copied into many repositories.

    Counted in three steps, each combined before its shuffle, so a value that a third of all rows hold is no hot group.
    """
    return (
        candidates.groupBy("secret", "owner", "repo")
        .agg(F.lit(1).alias("one"))
        .groupBy("secret", "owner")
        .agg(F.count("*").alias("repos"))
        .groupBy("secret")
        .agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))
        .withColumn("live", (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos))
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    owner_col: str = "source",
    repo_col: str = "doc_id",
    text_col: str = "text",
    max_owners: int = MAX_OWNERS,
    max_repos: int = MAX_REPOS,
) -> DataFrame:
    """One row per document: ``row_id``, ``row_hash``, ``base`` spans, ``spans`` (with live tokens), ``n_live``, ``n_example``."""
    found = stored(find_spans(docs, id_col, owner_col, repo_col, text_col))
    each = found.where((F.size("base") > 0) | (F.size("tokens") > 0)).select(
        "row_id", "row_hash", "owner", "repo", F.explode(F.concat("base", "tokens")).alias("span")
    )
    each = each.select("*", F.sha2("span.value", 256).alias("secret"))
    # Stored, so that both sides of the join are plain exchanges and a value that many documents hold can be split.
    verdicts = stored(ownership(each, max_owners, max_repos).select("secret", "live"))
    marks = (
        each.join(verdicts, "secret")
        .select("row_id", "row_hash", F.struct("span.start", "span.kind", "span.end", "span.value").alias("span"), "live")
        .groupBy("row_id", "row_hash")
        .agg(F.collect_set(F.struct("span", "live")).alias("marks"))  # at most the spans of one text
        .withColumnsRenamed({"row_id": "mark_id", "row_hash": "mark_hash"})
    )
    joined = found.join(marks, found.row_id.eqNullSafe(marks.mark_id) & (found.row_hash == marks.mark_hash), "left")
    all_marks = F.coalesce("marks", F.array().cast(marks.schema["marks"].dataType))
    added = F.transform(F.filter(all_marks, lambda m: m["live"] & (m["span"]["kind"] == len(KINDS))), lambda m: m["span"])
    return joined.select(
        "row_id",
        "row_hash",
        "base",
        F.sort_array(F.concat("base", added)).alias("spans"),
        F.size(F.filter(all_marks, lambda m: m["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter(all_marks, lambda m: ~m["live"])).cast("bigint").alias("n_example"),
    )


def named(spans: Column | str) -> Column:
    """``kind:start:end`` by start and kind, joined by commas."""
    names = F.array(*[F.lit(kind[0]) for kind in KINDS], F.lit(LIVE))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", owner_col: str = "source", repo_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by ``[SECRET]``, and the length of changed texts set anew."""
    spans = scan(docs, id_col, owner_col, repo_col, text_col).where(F.size("spans") > 0)
    name = "_".join(["spans", *docs.columns])  # clashes with no column
    spans = hinted(stored(spans.groupBy("row_id", "row_hash").agg(F.first("spans").alias(name))))
    hit = docs.join(spans, docs[id_col].eqNullSafe(spans["row_id"]) & (row_hash(docs, id_col, text_col) == spans["row_hash"]), "left")
    text = docs[text_col]
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        before = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["text"], before, F.lit(MARK))).otherwise(state["text"]).alias("text"),
        )

    cut = F.aggregate(name, start, step, lambda s: F.concat(s["text"], F.substring(text, s["at"] + 1, F.length(text))))
    changed = F.col(name).isNotNull()
    columns = {text_col: F.when(changed, cut).otherwise(text)}
    if length_col in docs.columns:
        columns[length_col] = F.when(changed, F.length(cut).cast(docs.schema[length_col].dataType)).otherwise(docs[length_col])
    return hit.select(*[columns[c].alias(c) if c in columns else docs[c] for c in docs.columns])

