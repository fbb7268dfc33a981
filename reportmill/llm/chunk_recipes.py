"""Exact duplicates by content-defined chunk recipes.

A text, with A-Z lower-cased, is cut where a rolling hash of the last 32 bytes has its top bits zero, so that equal
texts have equal chunks. A chunk's identifier is a digest of 128 bits, and a text's recipe is the ordered list of its
identifiers. Recipes are grouped; the texts themselves stay where they are read. What differs in its recipe differs in
its text. Of texts that share a recipe, each distinct chunk is moved once, and its identifier is verified: no two
different chunks may have the same one. If two have, all recipes are made anew with another digest, until none do.

Which texts share a recipe is told to the reading tasks by a bitmap of a fixed size. It may let other texts through as
well, whose chunks are then verified too; so its size bounds the broadcast and never changes a result.

Null text counts as empty, and all empty texts are equal. Of equal texts the row with the largest id stays, one without
an id only if there is no other; of repeated rows one stays. An empty table gives an empty result. Only the named
columns of the input are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportmill.llm.common import batch_of, hinted, map_slices, row_hash, rows_without, ship_package, slices, stored, text_of

#: Chunks are 512 bytes to 16 KiB long, about 2.5 KiB on average; the last one of a text can be shorter.
LEAST, MOST, CUT_BITS = 512, 16 << 10, 11
#: Bits of the map of shared recipes, 8 MiB.
MAP_BITS = 1 << 26
#: One random number for each byte value, for the rolling hash.
GEAR = np.random.default_rng(32).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def cut_places(data: np.ndarray) -> np.ndarray:
    """Where the hash of the 32 bytes up to and including a place asks for a cut behind it."""
    h = GEAR[data]
    for width in (1, 2, 4, 8, 16):
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h = wider
    return np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0)


def chunks_of(texts: list[bytes]) -> list[list[bytes]]:
    """The chunks of each text. They depend on that text alone: no cut is nearer to its start than ``LEAST``."""
    places = cut_places(np.frombuffer(b"".join(texts), np.uint8))
    out, begin = [], 0
    for text in texts:
        end = begin + len(text)
        lo, hi = np.searchsorted(places, (begin + LEAST - 1, end - 1))
        cuts, start = [], begin
        for place in (places[lo:hi] + 1).tolist():
            while place - start > MOST:
                start += MOST
                cuts.append(start)
            if place - start >= LEAST:
                start = place
                cuts.append(start)
        while end - start > MOST:
            start += MOST
            cuts.append(start)
        bounds = [0, *[c - begin for c in cuts], len(text)] if text else [0]
        out.append([text[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
        begin = end
    return out


def identifiers(chunks: list[bytes], seed: int, bits: int) -> np.ndarray:
    """Two numbers for each chunk: the halves of its digest."""
    digests = b"".join([xxhash.xxh3_128_digest(chunk, seed) for chunk in chunks])
    halves = np.frombuffer(digests, np.int64)
    return halves if bits >= 128 else halves & ((1 << bits // 2) - 1)


def lowered(batch: pa.RecordBatch) -> list[bytes]:
    return [text.lower() for text in batch.column("text").cast(pa.binary()).to_pylist()]


def recipes(docs: DataFrame, seed: int = 0, bits: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``row_id``, ``row_hash``, ``row_no`` (tells repeated rows apart once stored), ``n_bytes``, ``text_sha256``
    of the normalised text, its ``recipe`` and ``recipe_key``, a hash of that.
    """
    rows = docs.select(
        docs[id_col].alias("row_id"),
        row_hash(docs, id_col, text_col).alias("row_hash"),
        F.monotonically_increasing_id().alias("row_no"),
        text_of(docs, text_col).alias("text"),
    )

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = lowered(batch)
            lists = [identifiers(chunks, seed, bits) for chunks in chunks_of(texts)]
            return batch_of(
                row_id=(batch.column("row_id"), None),
                row_hash=(batch.column("row_hash"), None),
                row_no=(batch.column("row_no"), None),
                n_bytes=([len(t) for t in texts], pa.int64()),
                text_sha256=([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                recipe=(lists, pa.list_(pa.int64())),
                recipe_key=([key_of(ids) for ids in lists], pa.int64()),
            )

        return work

    kind = rows.schema["row_id"].dataType.simpleString()
    schema = f"row_id {kind}, row_hash bigint, row_no bigint, n_bytes bigint, text_sha256 string, recipe array<bigint>, recipe_key bigint"
    return map_slices(rows, make, schema)


def key_of(ids: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(ids.tobytes()) >> 1


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit for each value of ``recipe_key`` modulo ``bits``; at most ``bits / 64`` numbers come to the driver."""
    place = F.pmod("recipe_key", F.lit(bits))
    words = keys.select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(recipe_key, {bits}L) % 64 as int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(max(1, bits // 64), np.int64)
    out[found.column("word").to_numpy()] = found.column("bit").to_numpy()
    return out.view(np.uint64)


def shared_chunks(docs: DataFrame, marked: np.ndarray, seed: int, bits: int, text_col: str = "text") -> DataFrame:
    """The distinct chunks, with their identifiers, of the texts whose recipe is marked in the bitmap."""
    spark, size = docs.sparkSession, len(marked) * 64
    ship_package(spark)
    shared = spark.sparkContext.broadcast(marked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            for part in slices(batch):
                found = {}
                for chunks in chunks_of(lowered(part)):
                    ids = identifiers(chunks, seed, bits)
                    place = key_of(ids) % size
                    if int(shared.value[place >> 6]) >> (place & 63) & 1:
                        for k, chunk in enumerate(chunks):
                            found[int(ids[2 * k]), int(ids[2 * k + 1]), chunk] = True
                if found:
                    high, low, chunks = zip(*found, strict=True)
                    yield batch_of(high=(high, pa.int64()), low=(low, pa.int64()), chunk=(chunks, pa.binary()))

    return docs.select(text_of(docs, text_col).alias("text")).mapInArrow(run, "high bigint, low bigint, chunk binary").distinct()


def verified_recipes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 128, map_bits: int = MAP_BITS
) -> tuple[DataFrame, DataFrame]:
    """The recipes of all rows, and of those that several rows share their ``group_size`` and the row that ``stays``.

    No two different chunks of texts that share a recipe have the same identifier.
    """
    seed = 0
    while True:
        rows = stored(recipes(docs, seed, bits, id_col, text_col))
        groups = rows.groupBy("recipe_key", "recipe").agg(
            F.count(F.lit(1)).alias("group_size"), F.max(F.struct("row_id", "row_no", "row_hash")).alias("stays")
        )
        groups = stored(groups.where("group_size > 1"))
        chunks = shared_chunks(docs, bitmap(groups, map_bits), seed, bits, text_col)
        if chunks.groupBy("high", "low").count().where("count > 1").isEmpty():
            return rows, groups
        seed, bits = seed + 1, min(128, 2 * bits)


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 128, map_bits: int = MAP_BITS) -> DataFrame:
    """The recipe columns of every row, with ``keep_id`` and ``keep_hash`` of the row that stays, ``group_size`` and ``kept``."""
    rows, groups = verified_recipes(docs, id_col, text_col, bits, map_bits)
    named = hinted(groups).withColumnsRenamed({"recipe": "recipe_", "recipe_key": "key_"})
    found = rows.join(named, (rows.recipe_key == named.key_) & (rows.recipe == named.recipe_), "left")
    own = F.struct("row_id", "row_no", "row_hash")
    stays = F.coalesce("stays", own)
    return found.select(
        *rows.columns,
        stays.getField("row_id").alias("keep_id"),
        stays.getField("row_hash").alias("keep_hash"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (stays.getField("row_no") == F.col("row_no")).alias("kept"),
    )


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies. Only rows that are repeated, id and text, are moved."""
    found = stored(find_copies(docs, id_col, text_col).where("group_size > 1").select("row_id", "row_hash", "keep_id", "keep_hash", "kept"))
    same = F.col("row_id").eqNullSafe(F.col("keep_id")) & (F.col("row_hash") == F.col("keep_hash"))
    kept = rows_without(docs, found.where(~same), id_col, text_col)
    repeated = found.where(same & ~F.col("kept"))
    if repeated.isEmpty():
        return kept
    keys = hinted(stored(repeated.select(F.col("row_hash").alias("key_")).distinct()))
    name = "_".join(["key", *docs.columns])  # clashes with no column
    hashed = kept.withColumn(name, row_hash(docs, id_col, text_col))
    once = hashed.join(keys, hashed[name] == keys["key_"], "left_semi").dropDuplicates([name])
    return hashed.join(keys, hashed[name] == keys["key_"], "left_anti").unionByName(once).select(*docs.columns)
