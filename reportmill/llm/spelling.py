"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

Words of neighbouring lengths are dealt to cells. Of two near words the longer has ``m`` code points, and either all in
front of the middle place or all from it on are the same in both; so the pair meets in the cell of that prefix or of that
suffix, with ``m`` as the class. A cell with many words is dealt again in the same way, within what its words do not yet
share, down to a single place, where it holds no more words than there are letters; so every cell is small, and no pair
is left out. A pair that several cells hold, as in a run of the same letter, counts where its first difference lies.

In a cell the sorted list of what the words do not share is scanned for every word: the three cells of the edit matrix
around the diagonal are computed once for a prefix that neighbours in the list share, and a range of the list is skipped
when its shared prefix is more than one edit away. All words of many cells are scanned together in numpy, prefix by prefix.

A word's form is its near word with the largest count (ties: the smallest in code-point order) if that count is at least
``ratio`` times the word's; following forms leads to its root. Counts grow on that way, so it has no cycles.

Null texts have no words. A null id is written as nothing in the digest that picks damaged runs. Rows without a word or a
count are left out of a given vocabulary, and repeated words are added up. An empty table gives an empty result. Only the
named columns of the input are read, so further columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportmill.llm.common import batch_of, hinted, ship_package, stored, text_of

LETTERS = "A-Za-zÀ-ÿ"
#: Words of a cell that are scanned together; a larger cell is dealt again.
CELL = 1024
#: A task counts so many different words before it hands them on, and scans about so many rows at once.
COUNTER_WORDS, SCAN_ROWS = 200_000, 1 << 15
CELL_KEY = ["m", "a", "b", "pre", "suf"]


def damaged(run: str, h: int) -> str:
    """The run without its code point at ``h`` modulo its length."""
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, least: int = 6, damage: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n``: runs of letters, A-Z lower-cased, of at least ``least`` code points, over all documents.

    With ``damage``, the runs of a document whose CRC-32 (of id, colon, run) it divides lose one code point first.
    """
    rows = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"), text_of(docs, text_col).alias("text"))
    pattern = f"[{LETTERS}]{{{least},}}"

    def handed(counted: Counter) -> pa.RecordBatch:
        return batch_of(word=(list(counted), pa.string()), n=(list(counted.values()), pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs_of, counted = re.compile(pattern).findall, Counter()
        for batch in batches:
            for name, text in zip(batch.column("id"), batch.column("text"), strict=True):
                found = runs_of(text.as_py().encode().lower().decode())
                if damage is None:
                    counted.update(found)
                else:
                    start = zlib.crc32(f"{name.as_py()}:".encode())
                    for word, n in Counter(found).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % damage == 0:
                            word = damaged(word, h)
                            if len(word) < least:
                                continue
                        counted[word] += n
                if len(counted) > COUNTER_WORDS:
                    yield handed(counted)
                    counted = Counter()
        yield handed(counted)

    ship_package(docs.sparkSession)
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def dealt(words: DataFrame) -> DataFrame:
    """Two cells for each word in the classes of its own length and of the next: by prefix and by suffix."""
    # As a cell that shares nothing yet, a class is dealt like any other cell.
    length = F.char_length("word")
    rows = words.select(F.explode(F.array(length, length + 1)).alias("m"), F.col("word").alias("middle"), "n")
    return halves(rows.withColumns({"a": F.lit(0), "b": F.lit(0), "pre": F.lit(""), "suf": F.lit("")}))


def halves(cells: DataFrame) -> DataFrame:
    """The rows of cells dealt again: the front half of what may differ is shared, or the rest behind it is."""
    half = "cast((m - a - b) div 2 as int)"
    rest = f"(m - a - b - {half})"
    front = f"""named_struct('m', m, 'a', a + {half}, 'b', b, 'pre', concat(pre, left(middle, {half})), 'suf', suf,
        'middle', substring(middle, {half} + 1), 'n', n)"""
    back = f"""named_struct('m', m, 'a', a, 'b', b + {rest}, 'pre', pre, 'suf', concat(right(middle, {rest}), suf),
        'middle', left(middle, char_length(middle) - {rest}), 'n', n)"""
    return cells.select(F.inline(F.expr(f"array({front}, {back})")))


def bounded_cells(words: DataFrame, limit: int = CELL) -> DataFrame:
    """The cells of the words, none with more than ``limit`` words unless they differ in a single place."""
    done, cells = [], stored(dealt(words))
    while True:
        large = cells.where("m - a - b > 1").groupBy(*CELL_KEY).count().where(f"count > {limit}").select(*CELL_KEY)
        large = stored(large)
        if large.isEmpty():
            done.append(cells)
            break
        done.append(cells.join(hinted(large), CELL_KEY, "left_anti"))
        cells = stored(halves(cells.join(hinted(large), CELL_KEY)))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def shared_prefixes(codes: np.ndarray, start: np.ndarray, length: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """For each row of the sorted list, how much it shares with the row before; -1 in front of a cell."""
    out = np.where(np.r_[True, cell[1:] != cell[:-1]], -1, 0)
    at, depth = np.flatnonzero(out == 0), 0
    while len(at):
        at = at[(length[at] > depth) & (length[at - 1] > depth)]
        at = at[codes[start[at] + depth] == codes[start[at - 1] + depth]]
        depth += 1
        out[at] = depth
    return out


def scan(middles: list[str], cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ordered pairs of rows of the same cell that are one edit apart; the rows of a cell are sorted and different."""
    codes = np.frombuffer("".join(middles).encode("utf-32-le"), np.uint32)
    codes = np.append(codes, np.uint32(0))
    length = np.array([len(w) for w in middles], np.int64)
    start = np.cumsum(length) - length
    lcp = shared_prefixes(codes, start, length, cell)
    first = np.flatnonzero(lcp < 0)
    bounds = np.append(first, len(middles))
    number = np.cumsum(lcp < 0) - 1
    # A row of the matrix for a query and a range of the list that shares ``depth`` code points.
    q = np.arange(len(middles))
    lo, hi = bounds[number], bounds[number + 1]
    left, mid, right = np.full(len(q), 2, np.int8), np.zeros(len(q), np.int8), np.where(length > 0, 1, 2).astype(np.int8)
    asked, found, depth = [], [], 0
    while len(q):
        ended = length[lo] == depth
        off = length[q] - depth
        last = np.select([off == -1, off == 0, off == 1], [left, mid, right], 2)
        hit = ended & (last == 1)
        asked.append(q[hit])
        found.append(lo[hit])
        lo = lo + ended
        # The ranges that share one code point more.
        starts = np.flatnonzero(lcp <= depth)
        i, j = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
        n = np.maximum(j - i, 0)
        parent = np.repeat(np.arange(len(q)), n)
        place = np.arange(len(parent)) - np.repeat(np.cumsum(n) - n, n) + i[parent]
        begin = starts[place]
        follow = np.append(starts, len(middles))[place + 1]
        end = np.minimum(follow, hi[parent])
        q, left, mid, right = q[parent], left[parent], mid[parent], right[parent]
        alone = (begin == q) & (end == q + 1)
        q, lo, hi, left, mid, right = (x[~alone] for x in (q, begin, end, left, mid, right))
        # The next row of the matrix, saturated at two edits.
        c, base, n = codes[start[lo] + depth], start[q] + depth, length[q]
        differs = lambda k: (codes[np.clip(base + k, 0, len(codes) - 1)] != c).astype(np.int8)
        new_left = np.where(n >= depth, np.minimum(left + differs(-1), mid + 1), 2)
        new_mid = np.where(n >= depth + 1, np.minimum(np.minimum(mid + differs(0), right + 1), new_left + 1), 2)
        new_right = np.where(n >= depth + 2, np.minimum(right + differs(1), new_mid + 1), 2)
        near = np.minimum(np.minimum(new_left, new_mid), new_right) <= 1
        q, lo, hi = q[near], lo[near], hi[near]
        left, mid, right = (np.minimum(x[near], 2).astype(np.int8) for x in (new_left, new_mid, new_right))
        depth += 1
    return np.concatenate(asked), np.concatenate(found)


def cell_links(rows: dict[str, list]) -> pa.RecordBatch:
    """For each word with near ones in its cell: their number, and the best of them. Rows are whole cells, sorted."""
    middles, n = rows["middle"], np.array(rows["n"], np.int64)
    keys = list(zip(*[rows[k] for k in CELL_KEY], strict=True))
    cell = np.cumsum([0] + [x != y for x, y in zip(keys[1:], keys[:-1], strict=True)])
    asked, found = scan(middles, cell)
    most = np.array(rows["m"]) - np.array(rows["a"]) - np.array(rows["b"])
    length = np.array([len(w) for w in middles])
    count = max(1, len(middles))
    # Two words shorter than the class meet in their own class.
    keep = np.maximum(length[asked], length[found]) == most[asked]
    # An inserted letter that continues in the shared suffix is counted where that letter's run ends.
    for k in np.flatnonzero(keep & (length[asked] != length[found])).tolist():
        x, y = sorted((middles[asked[k]], middles[found[k]]), key=len)
        keep[k] = not (y.startswith(x) and rows["suf"][asked[k]].startswith(y[-1]))
    asked, found = asked[keep], found[keep]
    words = [p + w + s for p, w, s in zip(rows["pre"], middles, rows["suf"], strict=True)]
    rank = np.empty(count, np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[found], -n[found], asked))
    asked, found = asked[order], found[order]
    head = np.flatnonzero(np.r_[True, asked[1:] != asked[:-1]]) if len(asked) else np.zeros(0, np.int64)
    return batch_of(
        word=([words[k] for k in asked[head].tolist()], pa.string()),
        n_near=(np.diff(np.append(head, len(asked))), pa.int64()),
        best_n=(n[found[head]], pa.int64()),
        best=([words[k] for k in found[head].tolist()], pa.string()),
    )


def near_words(words: DataFrame, limit: int = CELL) -> DataFrame:
    """``word``, ``n_near``, and its near word with the largest count (``best``, ``best_n``), for words that have any."""
    cells = bounded_cells(words, limit)
    names = [*CELL_KEY, "middle", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {name: [] for name in names}
        for batch in batches:
            for name in names:
                held[name] += batch.column(name).to_pylist()
            total = len(held["n"])
            if total < SCAN_ROWS:
                continue
            # The last cell may go on in the next batch.
            key, cut = tuple(held[k][-1] for k in CELL_KEY), total
            while cut and tuple(held[k][cut - 1] for k in CELL_KEY) == key:
                cut -= 1
            if cut:
                yield cell_links({name: held[name][:cut] for name in names})
                held = {name: held[name][cut:] for name in names}
        if held["n"]:
            yield cell_links(held)

    ship_package(words.sparkSession)
    rows = cells.select(*names).repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY, "middle")
    links = rows.mapInArrow(run, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return links.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("first")).select(
        "word", "n_near", (-F.col("first.less")).alias("best_n"), "first.best"
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for the words that have a ``form``; ways are halved in each round."""
    led = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = led.select(F.col("word").alias("root"), F.col("root").alias("far"))
        new = stored(led.join(ahead, "root", "left").select("word", F.coalesce("far", "root").alias("root"), "far"))
        led = new.select("word", "root")
        if new.where("far IS NOT NULL").isEmpty():
            return led


def variants(words: DataFrame, ratio: int = 5, limit: int = CELL) -> DataFrame:
    """For each word of a vocabulary (``word``, ``n``): ``form``, ``root``, ``n``, ``n_near`` and ``form_n``."""
    words = words.where("word <> '' AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))
    words = stored(words)
    named = words.join(near_words(words, limit), "word", "left")
    strong = F.col("best_n") >= ratio * F.col("n")
    named = stored(
        named.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(strong, F.col("best")).alias("form"), F.when(strong, F.col("best_n")).alias("form_n"))
    )
    led = roots(named.where("form IS NOT NULL"))
    return named.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
