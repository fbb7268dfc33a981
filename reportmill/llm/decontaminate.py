"""Benchmark decontamination by pigeonhole edit matching.

A test item is cut into segments, and a segment with an error budget of k edits into k + 1 pieces. Whoever copies the
segment with at most k edits leaves one piece as it is, so exact piece hits (one automaton over all pieces) give every
candidate place. Each place is verified with Myers' bit-parallel edit distance, many places at a time in numpy.

Both sides are lower-cased and runs of white space count as one blank. Null and empty texts match nothing; items with
fewer than ``MIN_CHARS`` characters are matched without edits and at word bounds only. Repeated items count under each
of their ids, all items without an id together under the null id. Repeated rows each give a row. Empty tables give an
empty result. The items are a query set: they are read in blocks of bounded size, and each block is matched against all
documents; the result does not depend on the number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportmill.llm.common import row_hash, ship_package, slices, stored, text_of

#: One edit is allowed for so many characters; pieces are about as long.
CHARS_PER_EDIT = 16
#: Segments have at least so many characters, unless the item is shorter.
SEGMENT = 100
#: Shorter items are matched as they are, as whole words.
MIN_CHARS = 24
#: Characters of test items that one pass over the documents handles.
BLOCK_CHARS = 2_000_000
#: Places verified together.
BATCH = 4096
U = np.uint64
ONE = U(1)


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def segments(item: str, size: int = SEGMENT) -> list[str]:
    """A normalised item in parts of about equal length, at least ``size`` where it is that long."""
    n = max(1, len(item) // size)
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [item[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def pieces(segment: str, chars_per_edit: int = CHARS_PER_EDIT) -> tuple[int, list[tuple[int, str]]]:
    """The error budget, and one piece more than that with their offsets."""
    budget = len(segment) // chars_per_edit
    cuts = [len(segment) * k // (budget + 1) for k in range(budget + 2)]
    return budget, [(a, segment[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(patterns: Sequence[str], windows: Sequence[str]) -> np.ndarray:
    """For each pair, the smallest edit distance between the pattern and any part of the window."""
    count, words = len(patterns), -(-max(map(len, patterns)) // 64)
    distinct = {p: k for k, p in enumerate(dict.fromkeys(patterns))}
    letters = {c: k + 1 for k, c in enumerate(sorted(set().union(*distinct)))}
    masks = np.zeros((len(distinct), len(letters) + 1, words), np.uint64)
    for pattern, k in distinct.items():
        for at, char in enumerate(pattern):
            masks[k, letters[char], at // 64] |= ONE << U(at % 64)
    longest = max(map(len, windows))
    codes = np.zeros((longest, count), np.int64)
    for k, window in enumerate(windows):
        codes[: len(window), k] = [letters.get(c, 0) for c in window]
    which = np.array([distinct[p] for p in patterns])
    length = np.array([len(p) for p in patterns])
    last_word, last_bit = (length - 1) // 64, ((length - 1) % 64).astype(np.uint64)
    up = np.full((words, count), U(0xFFFFFFFFFFFFFFFF))
    down = np.zeros((words, count), np.uint64)
    score = length.copy()
    best = score.copy()
    for column in range(longest):
        match = masks[which, codes[column]]
        plus = np.zeros(count, np.uint64)
        minus = np.zeros(count, np.uint64)
        for w in range(words):
            eq = match[:, w]
            vertical = eq | down[w]
            eq = eq | minus
            across = (((eq & up[w]) + up[w]) ^ up[w]) | eq
            rise = down[w] | ~(across | up[w])
            fall = up[w] & across
            here = last_word == w
            score = score + np.where(here, ((rise >> last_bit) & ONE).astype(np.int64) - ((fall >> last_bit) & ONE).astype(np.int64), 0)
            next_plus, next_minus = rise >> U(63), fall >> U(63)
            rise, fall = (rise << ONE) | plus, (fall << ONE) | minus
            up[w], down[w] = fall | ~(vertical | rise), rise & vertical
            plus, minus = next_plus, next_minus
        best = np.minimum(best, score)
    return best


def whole(text: str, start: int, end: int) -> bool:
    """Whether no word goes on beyond either end of ``text[start:end]``."""
    word = lambda k: 0 <= k < len(text) and (text[k].isalnum() or text[k] == "_")
    return not (word(start - 1) and word(start)) and not (word(end - 1) and word(end))


class Matcher:
    """Finds all (item, distance) that a text holds, for one block of items."""

    def __init__(self, items: Sequence[tuple[int | None, str]], size: int, chars_per_edit: int) -> None:
        import ahocorasick

        self.segments: list[tuple[str, int, list[int | None]]] = []
        self.short: dict[str, set[int | None]] = {}
        known: dict[str, int] = {}
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            if len(text) < MIN_CHARS:
                if text:
                    self.short.setdefault(text, set()).add(item_id)
                continue
            for part in segments(text, size):
                if part in known:
                    self.segments[known[part]][2].append(item_id)
                    continue
                known[part] = number = len(self.segments)
                budget, cut = pieces(part, chars_per_edit)
                self.segments.append((part, budget, [item_id]))
                for offset, piece in cut:
                    places.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece in places.keys() | self.short.keys():
            self.automaton.add_word(piece, (len(piece), places.get(piece, []), piece if piece in self.short else None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def __call__(self, texts: Sequence[str]) -> list[dict[int | None, int]]:
        """For each text the items found and their smallest distance."""
        found: list[dict[int | None, int]] = [{} for _ in texts]
        if not len(self.automaton):
            return found
        open_: list[tuple[int, int, str]] = []
        for k, text in enumerate(map(normal, texts)):
            starts: set[tuple[int, int]] = set()
            exact: set[int] = set()
            for end, (length, where, short) in self.automaton.iter(text):
                if short is not None and whole(text, end + 1 - length, end + 1):
                    found[k].update(dict.fromkeys(self.short[short], 0))
                for number, offset in where:
                    starts.add((number, end + 1 - length - offset))
            for number, start in starts:
                part = self.segments[number][0]
                if start >= 0 and text.startswith(part, start):
                    exact.add(number)
                    self._note(found[k], number, 0)
            for number, start in starts:
                if number not in exact:
                    part, budget, _ = self.segments[number]
                    open_.append((k, number, text[max(0, start - budget) : max(0, start + len(part) + budget)]))
            if len(open_) >= BATCH:
                self._verify(open_, found)
                open_ = []
        self._verify(open_, found)
        return found

    def _note(self, found: dict[int | None, int], number: int, distance: int) -> None:
        for item_id in self.segments[number][2]:
            found[item_id] = min(distance, found.get(item_id, distance))

    def _verify(self, places: list[tuple[int, int, str]], found: list[dict[int | None, int]]) -> None:
        places = sorted({p for p in places if p[2]}, key=lambda p: len(self.segments[p[1]][0]))
        for at in range(0, len(places), BATCH):
            part = places[at : at + BATCH]
            distances = myers([self.segments[n][0] for _, n, _ in part], [w for _, _, w in part])
            for (k, number, _), distance in zip(part, distances.tolist(), strict=True):
                if distance <= self.segments[number][1]:
                    self._note(found[k], number, distance)


def null_first(entry: tuple[int | None, int]) -> tuple[bool, int]:
    return entry[0] is not None, entry[0] or 0


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    segment: int = SEGMENT,
    chars_per_edit: int = CHARS_PER_EDIT,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``row_id``, ``row_hash`` and ``leaks``, an array of (item_id, distance), of the documents that hold a segment of an item."""
    spark = docs.sparkSession
    wanted = items.select(items[item_id_col].cast("bigint").alias("item_id"), text_of(items, item_text_col).alias("text"))
    total = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    rows = docs.select(docs[id_col].alias("row_id"), row_hash(docs, id_col, text_col).alias("row_hash"), text_of(docs, text_col).alias("text"))
    if blocks > 1:
        rows = stored(rows.withColumn("row_no", F.monotonically_increasing_id()))
    keys = [c for c in rows.columns if c != "text"]
    leaks_type = "array<struct<item_id:bigint,distance:int>>"
    schema = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys) + f", leaks {leaks_type}"
    leak = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32())]))
    ship_package(spark)

    def passed(block: int) -> DataFrame:
        # About block_chars characters at any size of the test set.
        part = [(r["item_id"], normal(r["text"])) for r in wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()]
        sent = spark.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import pyarrow.compute  # noqa: F401

            matcher = Matcher(sent.value, segment, chars_per_edit)
            for batch in batches:
                for rows in slices(batch):
                    leaks = matcher(rows.column("text").to_pylist())
                    hit = pa.array([bool(x) for x in leaks], pa.bool_())
                    values = pa.array([[{"item_id": i, "distance": d} for i, d in sorted(x.items(), key=null_first)] for x in leaks if x], leak)
                    yield pa.RecordBatch.from_arrays([*[rows.column(k).filter(hit) for k in keys], values], names=[*keys, "leaks"])

        return rows.mapInArrow(run, schema)

    if blocks == 1:
        return passed(0)
    out = passed(0)
    for block in range(1, blocks):
        out = out.union(passed(block))
    # One entry per test item and row, with the smallest distance of all blocks.
    each = out.select(*keys, F.inline("leaks")).groupBy(*keys, "item_id").agg(F.min("distance").alias("distance"))
    gathered = each.groupBy("row_no").agg(
        F.first("row_id").alias("row_id"), F.first("row_hash").alias("row_hash"), F.sort_array(F.collect_list(F.struct("item_id", "distance"))).alias("leaks")
    )
    return gathered.select("row_id", "row_hash", "leaks")
