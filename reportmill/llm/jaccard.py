"""N-gram Jaccard join on count vectors.

Shingles are hashed into coordinate groups. For a document of a size class the groups are laid out in blocks, one more
than the shingles in which two linked documents of the class can differ; so two linked documents have one block alike,
and a document is routed to one cell for each block. The documents of a cell meet in tasks of bounded size, in an
R-tree over their group counts: the sum of the coordinate minima of a point and of a node's upper corner bounds the
overlap, and pairs that the bound lets through are verified on the shingle sets.

Only components are wanted, so a pair that is already connected is not verified again and no group emits all its pairs.
In a first round a document meets the smallest first member of its cells, in chunks that all hold that member. In a
second one the cells that still hold several components are gone through; of those with more members than a task holds,
what is not in the largest component is compared with all the others, chunk by chunk.

Sets: the distinct n-word shingles of the text with A-Z lower-cased; with fewer words the whole sequence as one
shingle; null, empty and blank texts have an empty set, and are linked with nothing. Sets are compared through 64-bit
shingle hashes. Equal sets are one node, so copies and repeated rows cost one signature. A row with a null id takes part
like any other. An empty table gives an empty result. Only the named columns of the input are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportmill.llm.chunk_recipes import MAP_BITS, bitmap
from reportmill.llm.common import hinted, map_slices, row_hash, rows_without, ship_package, stored, text_of
from reportmill.llm.components import connected

#: Coordinates of a count vector, a byte each while no count is above 255.
GROUPS = 256
SEEDS = 6
LEAF = 16
#: Members of a cell that meet in one task; a task holds the sets of so many, and the first member's.
CHUNK = 256
#: Chunks of the second round are so many times larger: it is mostly count vectors that meet there, few texts follow.
GRID = 4
CACHE_WORDS = 300_000
#: So many shared cells, two numbers each, are broadcast; more are joined by a shuffle.
MAX_CELLS = 4_000_000
U = np.uint64
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


class Shingler:
    def __init__(self, width: int) -> None:
        self.width, self.known = width, {}

    def __call__(self, text: str) -> np.ndarray:
        """The sorted distinct shingle hashes of a text."""
        words = text.encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        known, hashed = self.known, []
        for word in words:
            value = known.get(word)
            if value is None:
                value = known[word] = xxhash.xxh3_64_intdigest(word)
            hashed.append(value)
        h = np.array(hashed, np.uint64)
        n = min(self.width, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            out = mix(out ^ h[k : len(h) - n + 1 + k])
        return np.unique(out)


@dataclass(frozen=True)
class Threshold:
    """Similarity ``num / den`` in integers, and the size classes that follow from it."""

    num: int
    den: int

    def linked(self, overlap: int, a: int, b: int) -> bool:
        return self.den * overlap >= self.num * (a + b - overlap) and overlap > 0

    def needed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The smallest overlap with which sets of these sizes are linked."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def partner(self, n: int) -> int:
        """The largest set that can be linked with one of size n."""
        return n * self.den // self.num

    def classes(self, largest: int) -> np.ndarray:
        """Where size classes start, each as wide as the reach of a size: a linked pair lies in one or in neighbours."""
        starts = [1]
        while starts[-1] <= largest:
            starts.append(self.partner(starts[-1]) + 1)
        return np.array(starts)

    def layouts(self, starts: np.ndarray) -> list[tuple[int, int]]:
        """For each size class: blocks, and how many of them may be empty. No blocks where linked sets are equal.

        Of ``blocks`` at most ``differ`` are not alike in a linked pair, whose smaller set lies in the class; so more
        than ``spare`` are alike.
        """
        out = []
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            n, m = end - 1, self.partner(end - 1)
            differ = n + m - 2 * int(self.needed(np.array(n), np.array(m)))
            if not differ:
                out.append((0, 0))
                continue
            best = None
            for spare in range(differ + 12):
                blocks = differ + 1 + spare
                empty = blocks * np.exp(-start / blocks)
                excess = empty + 2.5 * np.sqrt(empty) - spare
                if best is None or excess < best[0]:
                    best = (excess, blocks, spare)
                if excess <= 0.5:
                    break
            out.append(best[1:])
        return out


def signatures(shingles: np.ndarray, rule: Threshold, starts: np.ndarray, layouts: list[tuple[int, int]]) -> np.ndarray:
    """The cells of a set: in its size class, and in the one before if a smaller partner can lie there.

    A set with more empty blocks than are spare is laid out again with another hash; if all blocks that a pair has alike
    were empty, both sets are laid out again, so they still meet. Only after ``SEEDS`` layouts empty blocks make cells.
    """
    n = len(shingles)
    own = int(np.searchsorted(starts, n, "right")) - 1
    cells = []
    for k in (own, own - 1):
        if k < 0 or k < own and rule.partner(int(starts[own]) - 1) < n or not layouts[k][0]:
            continue
        blocks, spare = layouts[k]
        for seed in range(SEEDS):
            block = (mix(shingles ^ U(0x9E3779B97F4A7C15 + seed)) % U(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            block, mixed = block[order], mix(shingles[order] + U(k + 1))
            first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            total = np.zeros(blocks, np.uint64)
            total[block[first]] = np.add.reduceat(mixed, first)
            cell = mix(total ^ mix(np.arange(blocks, dtype=np.uint64) + U((k << 32) + (seed << 56))))
            enough = blocks - len(first) <= spare
            cells.append(cell[block[first]] if enough or seed < SEEDS - 1 else cell)
            if enough:
                break
    return np.concatenate(cells).view(np.int64) if cells else np.zeros(0, np.int64)


def group_counts(shingles: np.ndarray) -> np.ndarray:
    counts = np.bincount((mix(shingles) >> U(56)).astype(np.int64), minlength=GROUPS)
    return counts.astype(np.uint8 if counts.max() < 256 else np.int32)


def stored_counts(values: list[bytes]) -> np.ndarray:
    """Count vectors from their bytes, which tell the width by their number."""
    return np.stack([np.frombuffer(v, np.uint8 if len(v) == GROUPS else np.int32) for v in values])


class CountTree:
    """R-tree over count vectors, packed by size and then by the coordinates that spread most."""

    def __init__(self, points: np.ndarray) -> None:
        sizes = points.sum(axis=1, dtype=np.int64)
        widest = np.argsort(-points.var(axis=0), kind="stable")[:2]
        self.order = np.lexsort((points[:, widest[1]], points[:, widest[0]], sizes))
        self.points, self.levels = points[self.order], []
        upper, lower = self.points, sizes[self.order]
        while len(upper) > LEAF:
            cut = np.arange(0, len(upper), LEAF)
            upper, lower = np.maximum.reduceat(upper, cut), np.minimum.reduceat(lower, cut)
            self.levels.append((upper, lower))

    def search(self, point: np.ndarray, rule: Threshold) -> np.ndarray:
        """Indexes of the points that the bound does not exclude."""
        size = int(point.sum(dtype=np.int64))
        nodes = None
        for upper, lower in reversed(self.levels):
            at = np.arange(len(upper)) if nodes is None else np.concatenate([np.arange(n * LEAF, min(len(upper), (n + 1) * LEAF)) for n in nodes])
            bound = np.minimum(upper[at], point).sum(axis=1, dtype=np.int64)
            nodes = at[bound >= rule.needed(lower[at], size)]
            if not len(nodes):
                return nodes
        at = np.arange(len(self.points)) if nodes is None else np.concatenate([np.arange(n * LEAF, min(len(self.points), (n + 1) * LEAF)) for n in nodes])
        near = self.points[at]
        found = np.minimum(near, point).sum(axis=1, dtype=np.int64) >= rule.needed(near.sum(axis=1, dtype=np.int64), size)
        return self.order[at[found]]


def spanning_links(sets: list[np.ndarray], probes: list[int], rule: Threshold, parts: list[int]) -> list[tuple[int, int]]:
    """Links that connect what is linked among ``sets``, each probe against all; ``parts`` says what is connected."""
    tree = CountTree(np.stack([group_counts(s) for s in sets]))
    parent: dict[int, int] = {p: p for p in parts}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links, degree = [], np.zeros(len(sets), np.int64)
    for i in probes:
        near = tree.search(group_counts(sets[i]), rule)
        # Members with many links first: they connect the most with the fewest comparisons.
        for j in near[np.argsort(-degree[near], kind="stable")].tolist():
            a, b = root(parts[i]), root(parts[j])
            if a != b and rule.linked(len(np.intersect1d(sets[i], sets[j], assume_unique=True)), len(sets[i]), len(sets[j])):
                parent[b] = a
                degree[[i, j]] += 1
                links.append((i, j))
    return links


def chunks_of(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[tuple]]:
    """The rows of one chunk after the other, from batches sorted by chunk; the chunk is the first column."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*[batch.column(n).to_pylist() for n in names], strict=True):
            if rows and row[0] != rows[-1][0]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def near_members(rows: DataFrame, rule: Threshold) -> DataFrame:
    """Of rows sorted by chunk (chunk, d1, place, part, probe, head, counts) those that the tree's bound leaves a partner
    of another part; either of the two is a probe. No text is read for the others.
    """
    names = ["chunk", "d1", "place", "part", "probe", "head"]
    schema = "chunk string, d1 bigint, place bigint, part bigint, probe boolean, head boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in chunks_of(batches, [*names, "counts"]):
            points = stored_counts([row[6] for row in group])
            parts = np.array([row[3] for row in group])
            tree, keep = CountTree(points), np.zeros(len(group), bool)
            for i in [k for k, row in enumerate(group) if row[4]]:
                near = tree.search(points[i], rule)
                near = near[(parts[near] != parts[i]) & (near != i)]
                if len(near):
                    keep[i] = True
                    keep[near] = True
            if keep.any():
                columns = list(zip(*[row[:6] for row, k in zip(group, keep.tolist(), strict=True) if k], strict=True))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    ship_package(rows.sparkSession)
    return rows.select(*names, "counts").mapInArrow(run, schema)


def link_chunks(rows: DataFrame, width: int, rule: Threshold) -> DataFrame:
    """``rows``: chunk, d1, part, probe, text, sorted by chunk. Returns links (src, dst) between sets, named by ``d1``.

    Texts that are not of the set with digest ``d1`` are left out, as places are hashes.
    """
    schema = "src bigint, dst bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for group in chunks_of(batches, ["chunk", "d1", "part", "probe", "text"]):
            nodes, parts, probes, sets, known = [], [], [], [], set()
            for _, d1, part, probe, text in group:
                if d1 in known:
                    continue
                found = shingle(text)
                if digest(found) != d1:
                    continue
                known.add(d1)
                nodes.append(d1)
                parts.append(part)
                probes.append(probe)
                sets.append(found)
            if len(sets) > 1:
                links = spanning_links(sets, [i for i, p in enumerate(probes) if p], rule, parts)
                ends = [pa.array([nodes[link[k]] for link in links], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(ends, names=["src", "dst"])

    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def at_places(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Those of ``texts`` (place, text) whose place is marked in a bitmap of ``places``, and a few others.

    The bitmap has a fixed size, so it can be broadcast at any number of places. What it lets through besides is dropped
    by the join that follows; it keeps the other texts out of that join's shuffle.
    """
    spark = texts.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(bitmap(places.select(F.pmod("place", F.lit(MAP_BITS)).alias("recipe_key")), MAP_BITS))

    @F.pandas_udf("boolean")
    def marked(place: pd.Series) -> pd.Series:
        at = place.to_numpy() % MAP_BITS
        return pd.Series(shared.value[at >> 6] >> (at & 63).astype(np.uint64) & U(1) == 1)

    return texts.where(marked("place"))


def digest(shingles: np.ndarray) -> int:
    return int(np.add.reduce(mix(shingles + U(7))).view(np.int64)) if len(shingles) else 0


def features(docs: DataFrame, width: int, rule: Threshold, id_col: str, text_col: str) -> DataFrame:
    """Per row: ``row_id``, ``row_hash``, set size ``n``, two 64-bit digests of the set, its ``cells`` and group ``counts``."""
    rows = docs.select(docs[id_col].alias("row_id"), row_hash(docs, id_col, text_col).alias("row_hash"), text_of(docs, text_col).alias("text"))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        shingle, starts = Shingler(width), rule.classes(1 << 12)
        layouts = rule.layouts(starts)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal starts, layouts
            n, d1, d2, cells, counts = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle(text)
                if len(s) >= starts[-2]:
                    starts = rule.classes(2 * len(s))
                    layouts = rule.layouts(starts)
                n.append(len(s))
                counts.append(group_counts(s).tobytes())
                d1.append(digest(s))
                d2.append(int(np.bitwise_xor.reduce(mix(s ^ U(0x5851F42D4C957F2D))).view(np.int64)) if len(s) else 0)
                cells.append(signatures(s, rule, starts, layouts) if len(s) else np.zeros(0, np.int64))
            arrays = [batch.column("row_id"), batch.column("row_hash"), *[pa.array(v, pa.int64()) for v in (n, d1, d2)]]
            arrays += [pa.array(cells, pa.list_(pa.int64())), pa.array(counts, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["row_id", "row_hash", "n", "d1", "d2", "cells", "counts"])

        return work

    kind = rows.schema["row_id"].dataType.simpleString()
    return map_slices(rows, make, f"row_id {kind}, row_hash bigint, n bigint, d1 bigint, d2 bigint, cells array<bigint>, counts binary")


def linked_rows(docs: DataFrame, width: int, num: int, den: int, id_col: str, text_col: str, chunk: int = CHUNK) -> DataFrame:
    """``row_id``, ``row_hash``, ``n`` (set size) and ``class``, the same for rows that links of similarity >= num / den connect.

    Sets are named by their digest ``d1``, with or without an id, and each text is found at the smallest ``row_hash`` of
    its set, its ``place``. The class of an empty set is null.
    """
    rule = Threshold(num, den)
    rows = stored(features(docs, width, rule, id_col, text_col))
    sets = stored(rows.where("n > 0").groupBy("d1").agg(F.min("row_hash").alias("place"), F.first("counts").alias("counts")))
    texts = docs.select(row_hash(docs, id_col, text_col).alias("place"), text_of(docs, text_col).alias("text"))
    signed = rows.select("d1", F.explode("cells").alias("cell"))
    cells = signed.groupBy("cell").agg(F.min("d1").alias("first"), F.max("d1").alias("last")).where("first <> last").select("cell", "first")
    held = stored(signed.join(hinted(stored(cells), MAX_CELLS), "cell").select("cell", "first", "d1"))

    def linked(rows: DataFrame, key: list[str]) -> DataFrame:
        # Chunks are dealt by keys alone; the counts join last.
        rows = rows.select("d1", "part", "probe", "head", F.concat_ws("/", *key).alias("chunk")).join(sets, "d1")
        rows = stored(near_members(rows.repartition("chunk").sortWithinPartitions("chunk"), rule))
        rows = at_places(texts, rows).join(rows, "place").repartition("chunk").sortWithinPartitions("chunk", F.desc("head"), "d1")
        return stored(link_chunks(rows.select("chunk", "d1", "part", "probe", "text"), width, rule))

    # Round one: a set meets the smallest first member of all its cells, and whoever else does.
    met = stored(held.groupBy("d1").agg(F.min("first").alias("first")).where("first <> d1"))
    sizes = stored(met.groupBy("first").agg(F.count("*").alias("members")))
    spread = F.expr(f"cast(ceil(members / {chunk}) as bigint)")
    member = met.join(sizes, "first").select("first", "d1", F.pmod(F.xxhash64("d1"), spread).alias("chunk_no"), F.lit(False).alias("head"))
    heads = sizes.select("first", F.col("first").alias("d1"), F.explode(F.sequence(F.lit(0).cast("bigint"), spread - 1)).alias("chunk_no"), F.lit(True).alias("head"))
    links = linked(member.unionByName(heads).withColumns({"part": F.col("d1"), "probe": F.lit(True)}), ["first", "chunk_no"])
    labels = connected(links)
    # Round two: the members of cells that still hold several components, each pair of components once more.
    parts = hinted(stored(labels.select(F.col("node").alias("d1"), "label")))
    marked = held.join(parts, "d1", "left").select("cell", F.coalesce("label", "d1").alias("tag"))
    open_cells = marked.groupBy("cell").agg(F.min("tag").alias("a"), F.max("tag").alias("b")).where("a <> b").select("cell")
    again = held.join(hinted(stored(open_cells), MAX_CELLS), "cell").select("first", "d1").distinct()
    again = stored(again.join(parts, "d1", "left").select("first", "d1", F.coalesce("label", "d1").alias("part")))
    sizes = stored(again.groupBy("first").agg(F.count("*").alias("members")))
    wide = F.expr(f"cast(ceil(members / {GRID * chunk}) as bigint)")
    again = again.join(sizes, "first").withColumn("chunk_no", F.pmod(F.xxhash64("d1"), wide))
    small = again.where(f"members <= {GRID * chunk}").select("first", F.lit(-1).cast("bigint").alias("probe_no"), "chunk_no", "d1", "part", F.lit(True).alias("probe"))
    # In large groups what is not in the largest component is compared with all, chunk by chunk.
    large = stored(again.where(f"members > {GRID * chunk}"))
    counted = large.groupBy("first", "part").agg(F.count("*").alias("k"))
    main = stored(counted.groupBy("first").agg(F.max(F.struct("k", "part")).getField("part").alias("main")))
    others = large.join(main, "first").where("part <> main").withColumn("probe_no", F.col("chunk_no")).drop("chunk_no")
    grid = others.select("first", "probe_no").distinct().join(large.select("first", "chunk_no").distinct(), "first")
    asked = grid.join(others.select("first", "probe_no", "d1", "part"), ["first", "probe_no"]).withColumn("probe", F.lit(True))
    stay = grid.join(large.select("first", "chunk_no", "d1", "part"), ["first", "chunk_no"]).withColumn("probe", F.lit(False))
    dealt = asked.unionByName(stay).groupBy("first", "probe_no", "chunk_no", "d1").agg(F.max("probe").alias("probe"), F.first("part").alias("part"))
    more = linked(small.unionByName(dealt).withColumn("head", F.col("probe")), ["first", "probe_no", "chunk_no"])
    if not more.isEmpty():
        parts = hinted(stored(connected(links.unionByName(more)).select(F.col("node").alias("d1"), "label")))
    # Sets without a link are told apart by both digests and their size.
    alone = F.struct(F.col("d1").alias("a"), F.col("d2").alias("b"), F.col("n").alias("c"))
    none = F.lit(None).cast("bigint")
    together = F.struct(F.col("label").alias("a"), none.alias("b"), none.alias("c"))
    named = rows.select("row_id", "row_hash", "n", "d1", "d2").join(parts, "d1", "left")
    return named.select("row_id", "row_hash", "n", F.when(F.col("n") > 0, F.when(F.col("label").isNull(), alone).otherwise(together)).alias("class"))


def similar_components(
    docs: DataFrame, width: int = 5, num: int = 8, den: int = 10, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """``row_id``, ``n`` (set size) and ``component``, the smallest id reachable by links of similarity >= num / den, or null
    where no row of the component has an id. Ids may be of any type that has an order.
    """
    found = stored(linked_rows(docs, width, num, den, id_col, text_col, chunk))
    several = found.where("n > 0").groupBy("class").agg(F.min("row_id").alias("smallest"), F.count("*").alias("members"))
    several = hinted(stored(several.where("members > 1").select(F.col("class").alias("class_"), "smallest")))
    named = found.join(several, F.col("class").eqNullSafe(F.col("class_")) & (F.col("n") > 0), "left")
    return named.select("row_id", "n", F.when(F.col("class_").isNull(), F.col("row_id")).otherwise(F.col("smallest")).alias("component"))


def keep_one(docs: DataFrame, width: int = 5, num: int = 8, den: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the row with the smallest id, one without an id only if there is no other; of repeated rows one.

    Rows are told apart by id and text, so an id that several texts share, or that is null, neither joins texts nor drops
    one for the other. Texts without a word are no copies; of such rows only repeated ones go.
    """
    found = stored(linked_rows(docs, width, num, den, id_col, text_col))
    order = F.struct(F.col("row_id").isNull().alias("last"), "row_id", "row_hash")
    several = found.where("n > 0").groupBy("class").agg(
        F.min("row_hash").alias("a"), F.max("row_hash").alias("b"), F.min(order).getField("row_hash").alias("stays")
    )
    several = hinted(stored(several.where("a <> b").select(F.col("class").alias("class_"), "stays")))
    dropped = found.join(several, F.col("class").eqNullSafe(F.col("class_")) & (F.col("n") > 0)).where("row_hash <> stays")
    kept = rows_without(docs, dropped.select("row_id", "row_hash"), id_col, text_col)
    repeated = stored(found.groupBy("row_hash").count().where("count > 1").select(F.col("row_hash").alias("key_")))
    if repeated.isEmpty():
        return kept
    # Only repeated rows are moved to drop all but one of them.
    keys, name = hinted(repeated), "_".join(["key", *docs.columns])  # clashes with no column
    hashed = kept.withColumn(name, row_hash(docs, id_col, text_col))
    once = hashed.join(keys, hashed[name] == keys["key_"], "left_semi").dropDuplicates([name])
    return hashed.join(keys, hashed[name] == keys["key_"], "left_anti").unionByName(once).select(*docs.columns)
