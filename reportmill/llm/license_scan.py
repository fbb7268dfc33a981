"""License scan by patience alignment of texts with license templates.

Anchors are words that occur once in both the text window and the template; the longest increasing run of them is kept,
and the gaps between anchors are aligned in the same way, with equal words at their ends matched. The aligned share of
the template's words is the coverage. Besides, the phrases that identify the license (name, version, clause) must be
aligned word by word. So a text is aligned only around such a phrase, in windows of growing length that hold one copy.
Every disjoint copy is found. Of templates that align the same words of a text the one with the most aligned words stays,
so a three-clause text is not a two-clause text besides.

Words are lower-cased and stripped of punctuation. Null and blank texts match nothing; repeated rows match alike; an
empty table gives an empty result. Only the named columns of the input are read. The templates are a table that is read
in blocks of bounded size; the result does not depend on the number of blocks.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportmill.llm.common import map_slices, row_hash, stored, text_of
from reportmill.llm.license_templates import Template, all_templates

MIN_COVERAGE = 0.8
CACHE_WORDS = 300_000
STRIP = "\"'`.,;:!?()[]{}<>*#|&$%-_/\\"
#: Characters of templates that one pass over the documents handles.
BLOCK_CHARS = 4_000_000
#: Name, aligned words, template words, the words' range in the text, and the aligned words.
Match = tuple[str, int, int, int, int, list[int]]
MATCH = "license string, matched bigint, template_words bigint, first_word bigint, end_word bigint"


def template_texts() -> dict[str, str]:
    """The first text of each name. Templates are files, which are read on the driver alone."""
    return {name: text for name, text, _ in reversed(all_templates())}


def plain(word: str) -> str:
    return word.lower().strip(STRIP)


def longest_increasing(values: Sequence[int]) -> list[int]:
    """Indexes of a longest increasing subsequence of distinct values, by patience piles."""
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for k, value in enumerate(values):
        pile = bisect_left(tops, value)
        before[k] = ends[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(value)
            ends.append(k)
        else:
            tops[pile], ends[pile] = value, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def aligned_words(text: Sequence[int], template: Sequence[int]) -> list[tuple[int, int]]:
    """Pairs of aligned positions, in order in both."""
    pairs, open_ = [], [(0, len(text), 0, len(template))]
    while open_:
        a, b, c, d = open_.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a >= b or c >= d:
            continue
        once = {w for w, n in Counter(template[c:d]).items() if n == 1}
        seen = Counter(text[a:b])
        there = {template[k]: k for k in range(c, d)}
        common = [k for k in range(a, b) if text[k] in once and seen[text[k]] == 1]
        anchors = [(common[k], there[text[common[k]]]) for k in longest_increasing([there[text[k]] for k in common])]
        pairs += anchors
        for (x, y), (z, w) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)], strict=True):
            if anchors and z - x > 1 and w - y > 1:
                open_.append((x + 1, z, y + 1, w))
    return sorted(pairs)


def words_of(text: str) -> list[str]:
    return [w for w in map(plain, text.split()) if w]


def disjoint(matches: Iterable[Match]) -> list[Match]:
    """Of matches that share more than half of their aligned words the largest; in the order of the text."""
    taken: set[int] = set()
    kept = []
    for match in sorted(matches, key=lambda m: (-m[1], m[2], m[0], m[3], m[4])):
        if 2 * sum(k in taken for k in match[5]) <= len(match[5]):
            taken.update(match[5])
            kept.append(match)
    return sorted(kept, key=lambda m: (m[3], m[4], m[0]))


class Pattern:
    """A template with its phrases, and the phrase around which texts are aligned."""

    def __init__(self, name: str, words: list[int], phrases: list[list[int]], coverage: float) -> None:
        self.name, self.words, self.counts = name, words, Counter(words)
        self.need = ceil(coverage * len(words) - 1e-9)
        self.phrases = [(len(p), [k for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]) for p in phrases]

    def aligned(self, ids: Sequence[int], low: int, high: int) -> list[tuple[int, int]]:
        """The aligned words of ``ids[low:high]``, none without coverage or a phrase."""
        inside = Counter(ids[low:high])
        if sum(min(n, inside[w]) for w, n in self.counts.items()) < self.need:
            return []
        pairs = [(low + a, c) for a, c in aligned_words(ids[low:high], self.words)]
        if len(pairs) < self.need:
            return []
        at = {c: a for a, c in pairs}
        for length, starts in self.phrases:
            if not any(s in at and all(at.get(s + k) == at[s] + k for k in range(1, length)) for s in starts):
                return []
        return pairs

    def find(self, ids: Sequence[int], places: list[tuple[int, int]], alone: bool, width: int) -> list[Match]:
        """``places``: text positions of ``width`` words and their places in the template. Each stands for a copy of its own
        if ``alone``, so that no window holds two.
        """
        size, until, found = len(self.words), 0, []
        for n, (at, place) in enumerate(places):
            if at < until:
                continue
            low, high = until, len(ids)
            if alone:
                low = max(low, places[n - 1][0] + width if n else 0)
                high = places[n + 1][0] if n + 1 < len(places) else high
            best: list[tuple[int, int]] = []
            for slack in (0, size // 4 + 1, size):
                begin = at - place - slack
                pairs = self.aligned(ids, min(at, max(low, begin)), max(at + width, min(high, begin + size + 2 * slack)))
                if len(pairs) > len(best):
                    best = pairs
                if len(best) == size:
                    break
            if best:
                until = best[-1][0] + 1
                found.append((self.name, len(best), size, best[0][0], until, [a for a, _ in best]))
        return found


class Scanner:
    def __init__(self, templates: Sequence[Template], coverage: float) -> None:
        split = [(name, words_of(text), [words_of(k) for k in keys]) for name, text, keys in templates]
        self.vocab = {w: k for k, w in enumerate(dict.fromkeys(w for _, words, _ in split for w in words))}
        spread = Counter(w for _, words, _ in split for w in set(words))
        names = list(self.vocab)
        self.known: dict[str, int] = {}
        #: By the rarest word of a phrase: the pattern, the phrase, and the word's place in it.
        self.by_phrase: dict[int, list[tuple[Pattern, list[int], int]]] = {}
        #: Without phrases: by each of so many words that one of them is aligned in every copy.
        self.by_word: dict[int, list[Pattern]] = {}
        for name, words, keys in split:
            if not words:
                continue
            phrases = [[self.vocab.get(w, -3) for w in key] for key in keys if key]
            pattern = Pattern(name, [self.vocab[w] for w in words], phrases, coverage)
            if not all(starts for _, starts in pattern.phrases):
                raise ValueError(f"the template {name} lacks one of its phrases")
            if phrases:
                phrase = min(zip(phrases, pattern.phrases, strict=True), key=lambda p: (len(p[1][1]) > 1, -len(p[0])))[0]
                place = min(range(len(phrase)), key=lambda k: spread[names[phrase[k]]])
                self.by_phrase.setdefault(phrase[place], []).append((pattern, phrase, place))
            else:
                left = len(words) - pattern.need + 1
                for word in sorted(pattern.counts, key=lambda w: pattern.counts[w]):
                    if left <= 0:
                        break
                    left -= pattern.counts[word]
                    self.by_word.setdefault(word, []).append(pattern)

    def words(self, text: str) -> list[int]:
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        known, ids = self.known, []
        for word in text.split():
            number = known.get(word)
            if number is None:
                bare = plain(word)
                number = known[word] = self.vocab.get(bare, -1) if bare else -2
            if number != -2:
                ids.append(number)
        return ids

    def __call__(self, text: str) -> list[Match]:
        """All matches of each template, disjoint within a template."""
        ids = self.words(text)
        present = set(ids)
        hot = present & (self.by_phrase.keys() | self.by_word.keys())
        if not hot:
            return []
        where: dict[int, list[int]] = {}
        for k, w in enumerate(ids):
            if w in hot:
                where.setdefault(w, []).append(k)
        found: list[Match] = []
        loose: dict[int, tuple[Pattern, set[tuple[int, int]]]] = {}
        for word in sorted(hot):
            for pattern, phrase, place in self.by_phrase.get(word, ()):
                if sum(n for w, n in pattern.counts.items() if w in present) < pattern.need:
                    continue
                begins = [k - place for k in where[word] if k >= place and ids[k - place : k - place + len(phrase)] == phrase]
                if begins:
                    starts = next(starts for length, starts in pattern.phrases if pattern.words[starts[0] : starts[0] + length] == phrase)
                    places = [(k, s) for k in begins for s in starts]
                    found += pattern.find(ids, places, len(starts) == 1, len(phrase))
            for pattern in self.by_word.get(word, ()):
                if sum(n for w, n in pattern.counts.items() if w in present) >= pattern.need:
                    _, places_ = loose.setdefault(id(pattern), (pattern, set()))
                    places_.update((k, s) for k in where[word] for s, w in enumerate(pattern.words) if w == word)
        for pattern, places_ in loose.values():
            found += pattern.find(ids, sorted(places_), False, 1)
        return found


def template_table(spark: SparkSession) -> DataFrame:
    """The built-in templates: ``license``, ``text`` and ``phrases``, which must be aligned as they are."""
    return spark.createDataFrame([(n, t, list(k)) for n, t, k in all_templates()], "license string, text string, phrases array<string>")


def scan(
    docs: DataFrame,
    templates: DataFrame | dict[str, str] | None = None,
    coverage: float = MIN_COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per copy of a template found: ``row_id``, ``row_hash``, ``license``, ``matched``, ``template_words``,
    and the first and last word, counting from 0, the end exclusive.

    ``templates`` is a table like ``template_table``, or texts by name, which have no phrases.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("row_id"), row_hash(docs, id_col, text_col).alias("row_hash"), text_of(docs, text_col).alias("text"))
    id_type = rows.schema["row_id"].dataType.simpleString()
    if isinstance(templates, DataFrame):
        table = templates.select("license", "text", "phrases").where("license IS NOT NULL AND text IS NOT NULL")
        total = table.agg(F.sum(F.length("text"))).first()[0] or 0
        blocks = max(1, -(-total // block_chars))
        # About block_chars characters at any number of templates.
        block = F.pmod(F.xxhash64("license", "text"), F.lit(blocks))
        parts = lambda k: [(r["license"], r["text"], tuple(r["phrases"] or ())) for r in table.where(block == k).collect()]
    else:
        fixed: list[Template] = all_templates() if templates is None else [(name, text, ()) for name, text in templates.items()]
        dealt: list[list[Template]] = [[]]
        size = 0
        for template in fixed:
            if size and size + len(template[1]) > block_chars:
                dealt.append([])
                size = 0
            dealt[-1].append(template)
            size += len(template[1])
        blocks, parts = len(dealt), dealt.__getitem__

    def passed(rows: DataFrame, block: int, final: bool) -> DataFrame:
        sent = spark.sparkContext.broadcast(parts(block))

        def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
            scanner = Scanner(sent.value, coverage)

            def work(batch: pa.RecordBatch) -> pa.RecordBatch:
                found = [(k, *hit) for k, text in enumerate(batch.column("text").to_pylist()) for hit in (disjoint(scanner(text)) if final else scanner(text))]
                columns = list(zip(*found, strict=True)) if found else [()] * 7
                take = pa.array(columns[0], pa.int64())
                arrays = [batch.column("row_id").take(take), batch.column("row_hash").take(take), pa.array(columns[1], pa.string())]
                arrays += [pa.array(c, pa.int64()) for c in columns[2:6]]
                names = ["row_id", "row_hash", "license", "matched", "template_words", "first_word", "end_word"]
                if not final:
                    arrays += [pa.array(columns[6], pa.list_(pa.int64())), batch.column("row_no").take(take)]
                    names += ["aligned", "row_no"]
                return pa.RecordBatch.from_arrays(arrays, names=names)

            return work

        return map_slices(rows, make, f"row_id {id_type}, row_hash bigint, {MATCH}" + ("" if final else ", aligned array<bigint>, row_no bigint"))

    if blocks == 1:
        return passed(rows, 0, True)
    rows = stored(rows.withColumn("row_no", F.monotonically_increasing_id()))
    found = passed(rows, 0, False)
    for block_no in range(1, blocks):
        found = found.union(passed(rows, block_no, False))
    # At most the copies within one text.
    hits = F.collect_list(F.struct("license", "matched", "template_words", "first_word", "end_word", "aligned")).alias("hits")
    gathered = found.groupBy("row_no").agg(F.first("row_id").alias("row_id"), F.first("row_hash").alias("row_hash"), hits)

    def choose() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            kept = [(k, *m) for k, hits in enumerate(batch.column("hits").to_pylist()) for m in disjoint(tuple(h.values()) for h in hits)]
            columns = list(zip(*kept, strict=True)) if kept else [()] * 7
            take = pa.array(columns[0], pa.int64())
            arrays = [batch.column("row_id").take(take), batch.column("row_hash").take(take), pa.array(columns[1], pa.string())]
            arrays += [pa.array(c, pa.int64()) for c in columns[2:6]]
            return pa.RecordBatch.from_arrays(arrays, names=["row_id", "row_hash", "license", "matched", "template_words", "first_word", "end_word"])

        return work

    return map_slices(gathered.withColumn("size", F.lit("")), choose, f"row_id {id_type}, row_hash bigint, {MATCH}", "size")
