"""Exact substring removal over the corpus by suffix arrays of what can repeat.

Every window of ``length`` bytes has an anchor: the leftmost smallest hash of its ``GRAM``-byte parts, which depends on
the window's bytes only. Neighbouring windows with the same anchor make a context. Contexts whose anchor occurs once
hold nothing repeated; contexts that occur twice as a whole hold nothing else; both are settled by counting. The rest,
around the edges of repeated passages, is dealt by anchor, and the suffixes of the different contexts are sorted
(``suffixes``) to find the windows that they share. An anchor with very many different contexts is dealt by the windows
themselves instead, so no group is gathered in one task.

Texts are UTF-8 bytes; null and short texts keep all. Matches never cross documents and are judged on the input.
Repeated rows are copies of each other. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportmill.llm.common import hinted, map_slices, row_hash, ship_package, stored, text_of
from reportmill.llm.suffixes import Rolling, levels, mix, repeated_starts

GRAM = 50
#: Bytes that are hashed at once; longer texts are cut in overlapping parts.
PART = 1 << 20
#: An anchor with more different contexts than this is dealt by windows.
MAX_CONTEXTS = 4000
#: Context bytes that one suffix array covers, whole groups at a time.
SORT_BYTES = 2 << 20
U = np.uint64
LOW = U((1 << 22) - 1)


def contexts(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of the texts in ``data``: text number, first and last window start, anchor and context hashes of each context."""
    n = len(data) - length + 1
    if n < 1:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    rolling = Rolling(data)
    grams = rolling.grams(GRAM)
    span = length - GRAM + 1
    keys = (grams & ~LOW) | np.arange(len(grams), dtype=np.uint64)
    blocks = -(-len(keys) // span)
    padded = np.full(blocks * span, ~U(0))
    padded[: len(keys)] = keys
    rows = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(behind[:n], ahead[span - 1 : span - 1 + n]) & LOW).astype(np.int64)
    start = np.arange(n)
    text = np.searchsorted(bounds, start, "right") - 1
    valid = start + length <= bounds[text + 1]
    start, text, anchor = start[valid], text[valid], anchor[valid]
    if not len(start):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    fresh = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
    first, last = start[fresh], start[np.r_[fresh[1:] - 1, len(start) - 1]]
    text, anchor = text[fresh], anchor[fresh]
    whole = mix(rolling(first, last + length) ^ (anchor - first).astype(np.uint64) ^ ((last - first).astype(np.uint64) << U(32)))
    return text, first - bounds[text], last - bounds[text], grams[anchor].view(np.int64), whole.view(np.int64)


def context_rows(docs: DataFrame, length: int) -> DataFrame:
    """``docs``: row_id, row_hash, text (binary). One row per context."""
    id_type = docs.schema["row_id"].dataType.simpleString()

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            owner, offset, parts = [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                if len(text) >= length:
                    for at in range(0, max(1, len(text) - length + 1), PART):
                        owner.append(k)
                        offset.append(at)
                        parts.append(text[at : at + PART + length - 1])
            columns = [[] for _ in range(5)]
            at = 0
            while at < len(parts):
                end, size = at, 0
                while end < len(parts) and (end == at or size + len(parts[end]) <= PART):
                    size += len(parts[end])
                    end += 1
                bounds = np.r_[0, np.cumsum([len(p) for p in parts[at:end]])]
                text, first, last, anchor, whole = contexts(np.frombuffer(b"".join(parts[at:end]), np.uint8), bounds, length)
                shift = np.array(offset[at:end])[text]
                for column, value in zip(columns, (np.array(owner[at:end])[text], first + shift, last + shift, anchor, whole), strict=True):
                    column.append(value)
                at = end
            row, first, last, anchor, whole = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
            row = pa.array(row, pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("row_id").take(row), batch.column("row_hash").take(row), *[pa.array(c, pa.int64()) for c in (first, last, anchor, whole)]],
                names=["row_id", "row_hash", "first", "last", "anchor", "whole"],
            )

        return work

    return map_slices(docs, make, f"row_id {id_type}, row_hash bigint, first bigint, last bigint, anchor bigint, whole bigint")


def with_parts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` (row_id, row_hash, first, last, ...) with ``part``, the context's bytes."""
    each = wanted.groupBy("row_id", "row_hash").agg(F.collect_set(F.struct("anchor", "whole", "first", "last", "settled")).alias("contexts"))
    each = stored(each.withColumnsRenamed({"row_id": "id_", "row_hash": "hash_"}))
    joined = docs.join(each, same_row(docs, each)).select("row_id", "row_hash", "text", F.explode("contexts").alias("c"))
    # Positions count bytes, and so does substring on binary data.
    part = F.substring(F.col("text"), (F.col("c.first") + 1).cast("int"), (F.col("c.last") - F.col("c.first") + length).cast("int"))
    return joined.select("row_id", "row_hash", "c.anchor", "c.whole", "c.first", "c.settled", part.alias("part"))


def same_row(docs: DataFrame, other: DataFrame) -> Column:
    return docs["row_id"].eqNullSafe(other["id_"]) & (docs["row_hash"] == other["hash_"])


def sorted_windows(rows: DataFrame, length: int) -> DataFrame:
    """Rows sorted by anchor; gives ``row_id``, ``row_hash``, and runs of repeated window starts [low, high] of unsettled contexts."""
    id_type = rows.schema["row_id"].dataType.simpleString()
    names = ["row_id", "row_hash", "anchor", "first", "settled", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple] = []
        group: list[tuple] = []
        size = 0

        def settle(items: list[tuple]) -> pa.RecordBatch:
            cut = levels([x[5] for x in items], length)
            anchors = np.array([x[2] for x in items], np.int64)
            _, inverse = np.unique(anchors, return_inverse=True)
            worst = np.zeros(inverse.max() + 1, np.int64)
            np.maximum.at(worst, inverse, cut)
            ids, hashes, lows, highs = [], [], [], []
            for level in range(3):
                mine = np.flatnonzero(worst[inverse] == level).tolist()
                if not mine:
                    continue
                for k, starts in zip(mine, repeated_starts([items[i][5] for i in mine], length, level), strict=True):
                    if len(starts) and not items[k][4]:
                        breaks = np.flatnonzero(np.diff(starts) > 1)
                        for a, b in zip(np.r_[0, breaks + 1].tolist(), np.r_[breaks, len(starts) - 1].tolist(), strict=True):
                            ids.append(items[k][0])
                            hashes.append(items[k][1])
                            lows.append(items[k][3] + int(starts[a]))
                            highs.append(items[k][3] + int(starts[b]))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, kind), pa.array(hashes, pa.int64()), pa.array(lows, pa.int64()), pa.array(highs, pa.int64())], names=["row_id", "row_hash", "low", "high"]
            )

        kind = None
        for batch in batches:
            kind = batch.schema.field("row_id").type
            for row in zip(*[batch.column(n).to_pylist() for n in names], strict=True):
                if group and row[2] != group[-1][2]:
                    pending += group
                    group = []
                    if size > SORT_BYTES:
                        yield settle(pending)
                        pending, size = [], 0
                group.append(row)
                size += len(row[5])
        if pending or group:
            yield settle(pending + group)

    ship_package(rows.sparkSession)
    return rows.select(*names).mapInArrow(run, f"row_id {id_type}, row_hash bigint, low bigint, high bigint")


def hashed_windows(rows: DataFrame, length: int) -> DataFrame:
    """One row per window of the contexts: ``row_id``, ``row_hash``, ``start``, ``settled`` and two hashes of its bytes."""
    id_type = rows.schema["row_id"].dataType.simpleString()

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = batch.column("part").to_pylist()
            bounds = np.r_[0, np.cumsum([len(p) for p in parts])]
            data = np.frombuffer(b"".join(parts), np.uint8)
            at = np.arange(max(0, len(data) - length + 1))
            row = np.searchsorted(bounds, at, "right") - 1
            valid = at + length <= bounds[row + 1]
            at, row = at[valid], row[valid]
            one = Rolling(data)(at, at + length)
            two = Rolling(data ^ np.uint8(0xA5))(at, at + length)
            start = np.array(batch.column("first").to_pylist(), np.int64)[row] + at - bounds[row]
            take = pa.array(row, pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column(n).take(take) for n in ("row_id", "row_hash", "settled")]
                + [pa.array(start, pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
                names=["row_id", "row_hash", "settled", "start", "one", "two"],
            )

        return work

    return map_slices(rows, make, f"row_id {id_type}, row_hash bigint, settled boolean, start bigint, one bigint, two bigint", "part")


def repeated_runs(docs: DataFrame, length: int) -> DataFrame:
    """Runs [low, high] of window starts that also start elsewhere, for docs (row_id, row_hash, text as binary)."""
    rows = context_rows(docs, length)
    anchors = rows.groupBy("anchor").agg(F.count("*").alias("n"), F.min("whole").alias("a"), F.max("whole").alias("b")).where("n > 1")
    # Stored, so that both sides of the join are plain exchanges and a hot anchor can be split.
    anchors = stored(anchors.select("anchor", (F.col("a") == F.col("b")).alias("alike")))
    shared = stored(rows.join(anchors, "anchor"))
    counted = shared.where("NOT alike").groupBy("anchor", "whole").agg(
        F.count("*").alias("n"), F.min(F.struct("row_id", "row_hash", "first", "last")).alias("one")
    )
    # One context of each kind takes part in the sort; it is settled if it has copies.
    kinds = stored(counted.select("anchor", "whole", "one.*", (F.col("n") > 1).alias("settled")))
    groups = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.count_if(~F.col("settled")).alias("open"))
    groups = groups.where("kinds > 1 AND open > 0").select("anchor", (F.col("kinds") > MAX_CONTEXTS).alias("large"))
    wanted = kinds.join(groups, "anchor")
    parts = with_parts(docs, wanted.select("row_id", "row_hash", "anchor", "whole", "first", "last", "settled"), length)
    parts = stored(parts)
    large = stored(groups.where("large").select("anchor"))
    small_rows, large_rows = parts.join(hinted(large), "anchor", "left_anti"), parts.join(hinted(large), "anchor", "left_semi")
    found = sorted_windows(small_rows.repartition("anchor").sortWithinPartitions("anchor"), length)
    windows = hashed_windows(large_rows, length)
    twice = windows.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two")
    dealt = windows.where("NOT settled").join(twice, ["one", "two"]).select("row_id", "row_hash", F.col("start").alias("low"), F.col("start").alias("high"))
    copies = kinds.where("settled").select(F.col("anchor").alias("anchor_"), F.col("whole").alias("whole_"))
    settled = shared.where("alike").unionByName(
        shared.where("NOT alike").join(copies, (F.col("anchor") == F.col("anchor_")) & (F.col("whole") == F.col("whole_")), "left_semi")
    )
    return settled.select("row_id", "row_hash", F.col("first").alias("low"), F.col("last").alias("high")).union(found).union(dealt)


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``row_id``, ``row_hash``, ``n_bytes``, ``n_removed``, ``spans`` (start, end in bytes), ``kept_sha256`` and, unless
    ``keep_text`` is off, the ``kept`` bytes.
    """
    read = docs.select(
        docs[id_col].alias("row_id"), row_hash(docs, id_col, text_col).alias("row_hash"), F.encode(text_of(docs, text_col), "utf-8").alias("text")
    )
    id_type = read.schema["row_id"].dataType.simpleString()
    runs = repeated_runs(read, length)
    # At most the contexts of one text, each once.
    spans = stored(runs.groupBy("row_id", "row_hash").agg(F.collect_set(F.struct("low", "high")).alias("runs")).withColumnsRenamed({"row_id": "id_", "row_hash": "hash_"}))
    joined = read.join(spans, same_row(read, spans), "left").select("row_id", "row_hash", "text", "runs")

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, removed, all_spans, kept = [], [], [], []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                merged: list[list[int]] = []
                for low, high in sorted((r["low"], r["high"]) for r in runs or ()):
                    if merged and low <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], high + length)
                    else:
                        merged.append([low, high + length])
                cuts = [0, *[x for span in merged for x in span], len(text)]
                sizes.append(len(text))
                removed.append(sum(b - a for a, b in merged))
                all_spans.append([{"start": a, "end": b} for a, b in merged])
                kept.append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)))
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrays = [batch.column("row_id"), batch.column("row_hash"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(all_spans, spans_type)]
            arrays.append(pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()))
            names = ["row_id", "row_hash", "n_bytes", "n_removed", "spans", "kept_sha256"]
            if keep_text:
                arrays.append(pa.array(kept, pa.binary()))
                names.append("kept")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        return work

    schema = f"row_id {id_type}, row_hash bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string"
    return map_slices(joined, make, schema + (", kept binary" if keep_text else ""))
