"""The trie of conversation prefixes, found by hashing blocks of turns.

A conversation's turns are cut into blocks of a fixed length. A block's digest takes in every turn with its place, and
the digests of successive blocks are combined into a digest of the prefix that ends with the block. Conversations are
grouped by these prefix digests first. Of each distinct block one conversation stands for all; inside it, prefixes end at
every turn. Where the block is the only one that follows its prefix, these nodes have the block's members; only where
siblings diverge are the turns of the siblings grouped again.

Sums over a node's subtree are sums over its members: each node is owned by its smallest member, and a conversation owns
the rest of its way from some node on, so the distinct text below a node is what its members own, plus what the node's
own smallest member reads from it on and owns before. So no level of the trie waits for another, at any depth.

Places within a conversation, and digests along it, are running values: rows are ranged over the tasks by conversation
and order, and each task's totals are added to the next, so a conversation with a third of all rows is spread.

Turns are ordered by turn (null first), role, and MD5 of the text; null role or text counts as empty; repeated rows are
turns of their own. Rows without a conversation id belong to no conversation. Sequences are told apart by digests of 128
bits. A table without conversations has no nodes. Only the named columns are read, so further ones may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportmill.llm.common import batch_of, hinted, ship_package, stored

BLOCK = 4
#: Ids of a node's ends are joined to pieces of so many characters before they go to one task.
PIECE = 1 << 16
NODE, PARENT = ["depth", "d1", "d2"], ["up", "p1", "p2"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def running(rows: DataFrame, key: str, order: list[str], values: dict[str, tuple[str, str]]) -> DataFrame:
    """``rows`` with running values within ``key``, each given by its aggregate (``sum`` or ``bit_xor``) and its column.

    Rows are ranged over the tasks by key and order; the few keys that reach over several tasks, two for each task at
    most, get what comes before a task added.
    """
    ordering = [F.col(name).asc_nulls_first() for name in order]
    ranged = stored(rows.repartitionByRange(F.col(key).asc_nulls_first(), *ordering).withColumn("task_", F.spark_partition_id()))
    reach = ranged.groupBy(key).agg(F.min("task_").alias("low_"), F.max("task_").alias("high_")).where("low_ < high_").select(key)
    totals = ranged.join(F.broadcast(reach), key, "left_semi").groupBy(key, "task_")
    totals = totals.agg(*[F.expr(f"{aggregate}({column})").alias(name) for name, (aggregate, column) in values.items()])
    before = Window.partitionBy(key).orderBy("task_").rowsBetween(Window.unboundedPreceding, -1)
    added = totals.select(key, "task_", *[F.expr(f"{values[name][0]}({name})").over(before).alias(f"{name}_") for name in values])
    inside = Window.partitionBy(key, "task_").orderBy(*ordering).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({name: F.expr(f"{aggregate}({column})").over(inside) for name, (aggregate, column) in values.items()})
    both = local.join(F.broadcast(added), [key, "task_"], "left")
    whole: dict[str, Column] = {}
    for name, (aggregate, _) in values.items():
        earlier = F.coalesce(f"{name}_", F.lit(0))
        whole[name] = (F.col(name) + earlier if aggregate == "sum" else F.col(name).bitwiseXOR(earlier)).cast("bigint")
    return both.withColumns(whole).drop("task_", *[f"{name}_" for name in values])


def turn_steps(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``n_bytes`` of the text, and two digests of role and text, of every turn. No text is moved."""
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(
        turns[conv_col].alias("conv_id"),
        turns[turn_col].alias("turn_"),
        role.alias("role_"),
        F.md5(text.cast("binary")).alias("md5_"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.xxhash64(F.lit(1), role, text).alias("t1"),
        F.xxhash64(F.lit(2), role, text).alias("t2"),
        F.lit(1).alias("one_"),
    )
    rows = rows.where("conv_id IS NOT NULL").withColumn("arrival_", F.monotonically_increasing_id())
    placed = running(rows, "conv_id", ["turn_", "role_", "md5_", "arrival_"], {"pos": ("sum", "one_")})
    return placed.select("conv_id", "pos", "n_bytes", "t1", "t2")


def borrow_starts(steps: DataFrame, convs: DataFrame, family: int = 5, cycle: int = 9) -> DataFrame:
    """Every conversation rebuilt: the first ``h`` turns of its family's first one, then its own turns after its first ``h``.

    The family of ``c`` starts at ``c - c % family``; ``h`` is the CRC-32 of the decimal id modulo ``cycle``.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % cycle
    heads = steps.where(F.col("pos") < cycle)
    known = convs.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    given = known.join(heads.withColumnRenamed("conv_id", "base"), "base").where("pos <= h").select(*steps.columns)
    length = heads.groupBy(F.col("conv_id").alias("base")).agg(F.max("pos").alias("length"))
    moved = F.col("h") - F.coalesce("length", F.lit(0))
    short = hinted(stored(known.join(length, "base", "left").select("conv_id", moved.alias("moved")).where("moved > 0")))
    own = steps.where(F.col("pos") > h).join(short, "conv_id", "left")
    return given.unionByName(own.withColumn("pos", F.col("pos") - F.coalesce("moved", F.lit(0))).drop("moved"))


def block_prefixes(steps: DataFrame, block: int) -> DataFrame:
    """For every block of a conversation: the digest up to its end and before it, its depth, and the bytes before it."""
    blocks = steps.groupBy("conv_id", "blk").agg(
        F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"), F.sum("n_bytes").alias("size"), F.max("pos").alias("depth")
    )
    along = running(blocks, "conv_id", ["blk"], {"d1": ("bit_xor", "x1"), "d2": ("bit_xor", "x2"), "end_bytes": ("sum", "size")})
    return along.select(
        "conv_id", "blk", *NODE, "end_bytes", (F.col("end_bytes") - F.col("size")).alias("before"),
        F.col("d1").bitwiseXOR(F.col("x1")).alias("b1"), F.col("d2").bitwiseXOR(F.col("x2")).alias("b2"),
    )


def turn_prefixes(steps: DataFrame, groups: DataFrame) -> DataFrame:
    """The prefixes that end at each turn of every distinct block, read from the conversation that stands for it."""
    within = Window.partitionBy("conv_id", "blk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = steps.join(groups.withColumnsRenamed({"depth": "g", "d1": "g1", "d2": "g2"}), ["conv_id", "blk"])
    d1, d2 = (F.col(f"b{k}").bitwiseXOR(F.bit_xor(f"h{k}").over(within)) for k in (1, 2))
    rows = rows.withColumns({"d1": d1, "d2": d2, "read": F.sum("n_bytes").over(within)})
    return rows.select(
        "g", "g1", "g2", "alone", "conv_id", F.col("n").alias("n_convs"), F.col("pos").alias("depth"), "d1", "d2",
        (F.col("pos") - 1).alias("up"), F.col("d1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("d2").bitwiseXOR(F.col("h2")).alias("p2"),
        "n_bytes", (F.col("before") + F.col("read") - F.col("n_bytes")).alias("start"),
    )


def hashed_ends(ends: DataFrame) -> DataFrame:
    """For each node where conversations end, the SHA-256 of their ids in ascending order, joined by commas.

    Ranged tasks join the ids to long pieces, so that the one task that has to hash a node in order handles few rows.
    """
    kind = ends.schema["conv_id"].dataType.simpleString()
    ordered = [*NODE, "conv_id"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, None, [], 0

        def piece() -> pa.RecordBatch:
            columns = {n: ([v], pa.int64()) for n, v in zip(NODE, node, strict=True)}
            return batch_of(**columns, conv_id=([first], None), ids=([",".join(ids)], pa.string()))

        for batch in batches:
            for *own, conv in zip(*[batch.column(n).to_pylist() for n in ordered], strict=True):
                if own != node or size > PIECE:
                    if ids:
                        yield piece()
                    node, first, ids, size = own, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        done: list[tuple] = []
        for batch in batches:
            for *own, ids in zip(*[batch.column(n).to_pylist() for n in [*NODE, "ids"]], strict=True):
                if own == node:
                    state.update(b"," + ids.encode())
                else:
                    if state:
                        done.append((*node, state.hexdigest()))
                    node, state = own, hashlib.sha256(ids.encode())
            if len(done) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*done, strict=True)], names=[*NODE, "ends_sha256"])
                done = []
        if state:
            done.append((*node, state.hexdigest()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*done, strict=True)], names=[*NODE, "ends_sha256"])

    ship_package(ends.sparkSession)
    node = "depth bigint, d1 bigint, d2 bigint"
    pieces = ends.select(*ordered).repartitionByRange(*ordered).sortWithinPartitions(*ordered).mapInArrow(join, f"{node}, conv_id {kind}, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*ordered).mapInArrow(digest, f"{node}, ends_sha256 string")


def trie_of(steps: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie over ``steps`` (as :func:`turn_steps` gives them) and the ids of all conversations, turnless too.

    Per node: ``conv_id``, its smallest member; ``depth``; ``parent_conv_id``; ``n_convs``; ``n_children``; ``n_leaves``;
    ``saved_tokens``, the bytes that sharing prefixes saves in its subtree; and ``ends_sha256``.
    """
    # Turn-level digests, keyed by place; a prefix's digest is the exclusive or over its turns.
    keyed = [F.xxhash64(F.lit(k), "pos", "t1", "t2").alias(f"h{k}") for k in (1, 2)]
    steps = stored(steps.select("conv_id", "pos", "n_bytes", F.expr(f"(pos - 1) div {block}").alias("blk"), *keyed))
    blocks = stored(block_prefixes(steps, block))
    last = blocks.groupBy("conv_id").agg(F.max_by(F.struct(*NODE, "end_bytes"), "blk").alias("last"))
    zero = F.lit(0).cast("bigint")
    named = [F.coalesce(f"last.{n}", zero).alias(n) for n in (*NODE, "end_bytes")]
    ends = stored(convs.join(last, "conv_id", "left").select("conv_id", *named))

    # Distinct blocks, and whether another one follows the same prefix or a conversation ends there.
    groups = stored(
        blocks.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), *[F.first(c).alias(c) for c in ("blk", "before", "b1", "b2")]
        )
    )
    forks = stored(groups.groupBy("blk", "b1", "b2").count().where("count > 1").select("blk", "b1", "b2", F.lit(False).alias("fork")))
    groups = stored(groups.join(hinted(forks), ["blk", "b1", "b2"], "left").withColumn("alone", F.col("fork").isNull()).drop("fork"))
    inner = stored(turn_prefixes(steps, groups))
    told = ["conv_id", "n_convs", *PARENT, "n_bytes", "start"]
    refined = inner.where("NOT alone").groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), *[F.first(c).alias(c) for c in told[2:]]
    )
    nodes = stored(inner.where("alone").select(*NODE, *told).unionByName(refined.select(*NODE, *told)))

    kids = nodes.groupBy(*PARENT).agg(F.count(F.lit(1)).alias("n_children")).withColumnsRenamed(dict(zip(PARENT, NODE, strict=True)))
    kids = stored(kids)
    top = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = top.select(*[zero.alias(n) for n in NODE], "conv_id", "n_convs", *[F.lit(None).cast("bigint").alias(n) for n in PARENT], zero.alias("n_bytes"), zero.alias("start"))
    nodes = stored(nodes.unionByName(root).join(kids, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)))

    # What a conversation reads, owns, and owns first; whether it owns a leaf.
    owners = nodes.groupBy("conv_id").agg(
        F.sum("n_bytes").alias("owned"), F.min("start").alias("own_start"), F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf")
    )
    shares = stored(
        ends.join(owners, "conv_id", "left").select(
            "conv_id", "end_bytes", F.coalesce("owned", zero).alias("owned"), F.coalesce("own_start", zero).alias("own_start"), F.coalesce("leaf", zero).alias("leaf")
        )
    )
    sums = {"all_bytes": "end_bytes", "all_owned": "owned", "n_leaves": "leaf"}
    added = [F.sum(c).alias(n) for n, c in sums.items()]
    again = [F.sum(n).alias(n) for n in sums]
    by_block = blocks.select("conv_id", *NODE).join(shares, "conv_id").groupBy(*NODE).agg(*added)
    by_block = by_block.withColumnsRenamed({"depth": "g", "d1": "g1", "d2": "g2"})
    by_turn = inner.select("g", "g1", "g2", "alone", *NODE).join(by_block, ["g", "g1", "g2"])
    by_node = by_turn.where("alone").select(*NODE, *sums).unionByName(by_turn.where("NOT alone").groupBy(*NODE).agg(*again))
    by_root = shares.agg(*added).select(*[zero.alias(n) for n in NODE], *sums)
    by_node = stored(by_node.unionByName(by_root))

    parents = nodes.select(*[F.col(n).alias(p) for n, p in zip(NODE, PARENT, strict=True)], F.col("conv_id").alias("parent_conv_id"))
    firsts = shares.select("conv_id", "own_start")
    out = stored(nodes.join(by_node, NODE).join(hashed_ends(ends), NODE, "left"))
    out = stored(out.join(firsts, "conv_id")).join(stored(parents), PARENT, "left")
    distinct = F.col("all_owned") + F.col("own_start") - F.col("start")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("all_bytes") - F.col("n_convs") * F.col("start") - distinct).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def prefix_trie(
    turns: DataFrame, block: int = BLOCK, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The nodes of :func:`trie_of` for a table of turns."""
    return trie_of(turn_steps(turns, conv_col, turn_col, role_col, text_col), conversations(turns, conv_col), block)


def conversations(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The ids of all conversations."""
    return stored(turns.select(turns[conv_col].alias("conv_id")).where("conv_id IS NOT NULL").distinct())
