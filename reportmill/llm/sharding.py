"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns virtual nodes on a ring of bins. A row starts at the shard of its bin; where a shard is full, its rows
continue clockwise to the next shard that has room. Only the number of rows per bin goes to the driver, at most one
number for each of the fixed ``bins``; the rows are dealt within their bin by rank.

One id, null included, may hold a third of all rows. Rows alike in id and text are counted before they are shuffled and
written out in chunks by many tasks; others of one bin are ranked in ``SALTS`` parts by a hash of the text, whose counts
give the rank at which each part begins.

With ``slack`` 0 the capacities add up to the number of rows, so the shards' counts are at most one apart. Null ids and
repeated rows have a bin like any other; rows alike in id and text are interchangeable. An empty table gives an empty
result. Only the named columns of the input are read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportmill.llm.common import stored, text_of

BIN_BITS = 16
VIRTUAL_NODES = 128
SALTS = 256
#: Rows alike are written out in chunks of so many.
CHUNK = 1 << 16


def ring_order(shards: int, bins: int, virtual_nodes: int) -> np.ndarray:
    """For each bin, all shards in the order in which their virtual nodes follow clockwise."""
    owners: dict[int, int] = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            place = int.from_bytes(hashlib.sha256(f"{shard}/{node}".encode()).digest()[:8], "big") % bins
            owners.setdefault(place, shard)
    order = np.zeros((bins, shards), np.int64)
    # Going anticlockwise, a virtual node's shard comes first and the others keep their order.
    ahead: list[int] = []
    for place in sorted(owners, reverse=True):
        ahead = [owners[place], *[s for s in ahead if s != owners[place]]]
    for at in range(bins - 1, -1, -1):
        if at in owners:
            ahead = [owners[at], *[s for s in ahead if s != owners[at]]]
        order[at] = ahead + [s for s in range(shards) if s not in ahead]
    return order


def capacities(total: int, shards: int, slack: float) -> np.ndarray:
    if slack:
        return np.full(shards, math.ceil(total / shards * (1 + slack)), np.int64)
    return np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)


def deal(counts: np.ndarray, order: np.ndarray, room: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each bin, how many of its rows each shard takes, as (shard, rows).

    Rows overflow in rounds: in a round, the bins offer what they have left to their next shard, clockwise from bin 0,
    and the shard takes it until it is full.
    """
    room, left = room.copy(), counts.copy()
    taken: list[list[tuple[int, int]]] = [[] for _ in counts]
    for turn in range(order.shape[1]):
        for shard in range(order.shape[1]):
            mine = np.flatnonzero((order[:, turn] == shard) & (left > 0))
            before = np.cumsum(left[mine]) - left[mine]
            accepted = np.clip(room[shard] - before, 0, left[mine])
            for b, n in zip(mine.tolist(), accepted.tolist(), strict=True):
                if n:
                    taken[b].append((shard, n))
            left[mine] -= accepted
            room[shard] -= accepted.sum()
    return taken


def before(count: str, within: str, order: str) -> Column:
    """The sum of ``count`` over the rows that come earlier."""
    return F.expr(
        f"coalesce(sum({count}) OVER (PARTITION BY {within} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )


def assign(
    docs: DataFrame,
    shards: int,
    slack: float = 0.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    bin_bits: int = BIN_BITS,
    virtual_nodes: int = VIRTUAL_NODES,
) -> DataFrame:
    """``row_id``, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``shard`` and ``slot``, gapless within the shard."""
    spark, bins = docs.sparkSession, 1 << bin_bits
    text = text_of(docs, text_col)
    place = F.xxhash64(docs[id_col])
    rows = docs.select(
        docs[id_col].alias("row_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.shiftrightunsigned(place, 64 - bin_bits).cast("int").alias("bin"),
    ).withColumn("salt", F.pmod(F.xxhash64("row_id", "text_crc32", "size"), F.lit(SALTS)).cast("int"))
    alike = stored(rows.groupBy("bin", "salt", "row_id", "text_crc32", "size").agg(F.count("*").alias("n")))
    counts = np.zeros(bins, np.int64)
    for row in alike.groupBy("bin").agg(F.sum("n").alias("n")).collect():
        counts[row["bin"]] = row["n"]
    taken = deal(counts, ring_order(shards, bins, virtual_nodes), capacities(int(counts.sum()), shards, slack))
    filled = [0] * shards
    table = []
    for at, parts in enumerate(taken):
        upto, entry = 0, []
        for shard, n in parts:
            # A row with a rank below ``upto`` goes to ``shard``, at slot rank + shift.
            entry.append((upto + n, shard, filled[shard] - upto))
            upto += n
            filled[shard] += n
        if entry:
            table.append((at, entry))
    plan = spark.createDataFrame(table, "bin int, parts array<struct<upto:bigint,shard:int,shift:bigint>>")
    parts = alike.groupBy("bin", "salt").agg(F.sum("n").alias("n"))
    parts = parts.select("bin", "salt", before("n", "bin", "salt").alias("begin"))  # at most SALTS rows of a bin
    ranked = alike.withColumn("from", before("n", "bin, salt", "row_id, text_crc32, size")).join(parts, ["bin", "salt"])
    ranked = ranked.withColumn("from", F.col("from") + F.col("begin")).withColumn("upto", F.col("from") + F.col("n"))
    chunks = ranked.withColumn("low", F.explode(F.expr(f"sequence(`from`, upto - 1, {CHUNK}L)"))).join(F.broadcast(plan), "bin")
    rows = chunks.repartition("bin", "low").withColumn("rank", F.explode(F.expr(f"sequence(low, least(low + {CHUNK - 1}, upto - 1))")))
    part = F.get(F.filter("parts", lambda p: p["upto"] > F.col("rank")), F.lit(0))
    return rows.select("row_id", "size", "text_crc32", part["shard"].alias("shard"), (F.col("rank") + part["shift"]).alias("slot"))
