"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word is the hashed embedding of its stem and what a small bidirectional network with attention reads from its characters; a second
such network reads the words of a window. A text's score is the highest of its overlapping windows, which cover all of
it. Words longer than ``WORD_CHARS`` are read as several. Labels are per document, so training picks the highest of all
windows of each document (first only documents of few windows) and learns from that; the loss on documents held back
from it says which state to keep.

Null and blank texts get the score of a window without words. Repeated rows are scored alike; labels of unknown documents
and null labels are left out; without a label of each kind every score is 0. An empty table gives an empty result. Only
the named columns of the input are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportmill.llm.common import map_slices, row_hash, text_of

WINDOW, STRIDE = 160, 120
WORD_CHARS = 24
CHAR_ROWS, CHAR_DIM, CHAR_HIDDEN = 512, 8, 8
WORD_ROWS, WORD_DIM, HIDDEN = 4096, 8, 8
STEM = 5
#: At most so many labelled documents of each kind are used for training, whole, and no further ones after so many bytes.
MAX_TOXIC, MAX_CLEAN, MAX_BYTES = 2000, 3000, 32 << 20
#: Training begins with ``WARM`` steps on documents of few windows; the last quarter of ``STEPS`` goes at a lower rate. From
#: then on the loss on held-back documents (one in ``HELD`` of each kind) is looked at after each pass and at the end, and the
#: state with the lowest loss is taken.
WARM, HELD, STEPS, BATCH, RATE = 120, 8, 1000, 48, 0.01
#: In training, this share of the words is known by characters only, so that rare words are not learned by heart.
UNKNOWN = 0.6
CACHE_WORDS = 150_000
GROUP = 512
Params = dict[str, np.ndarray]


def words_of(text: str) -> list[str]:
    """Lower-cased words, long ones in parts."""
    words = text.lower().split()
    if any(len(w) > WORD_CHARS for w in words):
        words = [w[i : i + WORD_CHARS] for w in words for i in range(0, len(w), WORD_CHARS)]
    return words


def window_starts(n: int) -> list[int]:
    """Windows overlap and cover all words; the last one ends with the text."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def init(seed: int = 7) -> Params:
    rng = np.random.default_rng(seed)
    make = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p: Params = {"chars": make(CHAR_ROWS, CHAR_DIM) * np.float32(8), "words": make(WORD_ROWS, WORD_DIM) * np.float32(8)}
    for level, dim, hidden in (("c", CHAR_DIM, CHAR_HIDDEN), ("w", WORD_DIM + 2 * CHAR_HIDDEN, HIDDEN)):
        for way in "fb":
            p |= {f"{level}{way}x": make(dim, 3 * hidden), f"{level}{way}h": make(hidden, 3 * hidden), f"{level}{way}b": np.zeros(3 * hidden, np.float32)}
        p |= {f"{level}a": make(2 * hidden, hidden), f"{level}v": make(hidden)}
    return p | {"out": make(2 * HIDDEN), "bias": np.full(1, -1, np.float32)}


class Steps:
    """The steps of rows that come by falling length, without padding: all rows' first step, then all second steps.

    Networks read arrays (values, steps) in this order; numpy is slow on slices of a few values each, so steps are last.
    """

    def __init__(self, lengths: np.ndarray) -> None:
        self.rows, steps = len(lengths), max(1, int(lengths.max(initial=1)))
        self.mask = np.arange(steps)[:, None] < lengths
        self.count = np.searchsorted(-lengths, -np.arange(steps), "left")  # these are the first ones
        self.first = np.cumsum(self.count) - self.count
        time, self.row = np.nonzero(self.mask)
        #: Where a step goes when every row is read from its end; the same way back.
        self.turn = self.first[lengths[self.row] - 1 - time] + self.row
        self.parts = [(k, slice(at, at + k)) for k, at in zip(self.count.tolist(), self.first.tolist(), strict=True) if k]


def gru(gates: np.ndarray, at: Steps, recur: np.ndarray, trace: list | None = None) -> np.ndarray:
    """Hidden states (way, hidden, steps) for input gates (way, 3 hidden, steps), both ways at once."""
    h = recur.shape[1]
    turned = np.ascontiguousarray(recur.transpose(0, 2, 1))
    state, out = np.zeros((2, h, at.rows), gates.dtype), np.empty((2, h, gates.shape[2]), gates.dtype)
    for k, part in at.parts:
        old = state[:, :, :k]
        up = turned @ old
        zr = gates[:, : 2 * h, part] + up[:, : 2 * h]
        zr *= 0.5
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        z, r = zr[:, :h], zr[:, h:]
        n = r * up[:, 2 * h :]
        n += gates[:, 2 * h :, part]
        np.tanh(n, out=n)
        if trace is not None:
            trace.append((k, part, old.copy(), z, r, n, up[:, 2 * h :]))
        new = old - n
        new *= z
        new += n
        state[:, :, :k] = out[:, :, part] = new
    return out


def gru_back(grad: np.ndarray, at: Steps, trace: list, recur: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input gates and of the recurrent weights."""
    h = recur.shape[1]
    d_gates, d_recur = np.empty((2, 3 * h, grad.shape[2]), grad.dtype), np.zeros_like(recur)
    carry = np.zeros((2, h, at.rows), grad.dtype)
    for k, part, state, z, r, n, un in reversed(trace):
        d = grad[:, :, part] + carry[:, :, :k]
        rest = 1 - z
        d_up = np.empty((2, 3 * h, k), grad.dtype)
        d_up[:, :h] = (state - n) * z * d * rest
        dn = (1 - n * n) * rest * d
        d_up[:, h : 2 * h] = (r - r * r) * un * dn
        d_up[:, 2 * h :] = dn * r
        d_gates[:, : 2 * h, part] = d_up[:, : 2 * h]
        d_gates[:, 2 * h :, part] = dn
        d_recur += state @ d_up.transpose(0, 2, 1)
        d *= z
        d += recur @ d_up
        carry[:, :, :k] = d
    return d_gates, d_recur


def summed(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Values (values, steps) summed by number, for the numbers 0 to ``n`` - 1."""
    return np.stack([np.bincount(at, v, n) for v in values]).astype(values.dtype)


def both_ways(values: np.ndarray, at: Steps) -> np.ndarray:
    """Values (two times some, steps) as (way, some, steps), each way in the order in which it is read."""
    half = len(values) // 2
    return np.stack([values[:half], values[half:][:, at.turn]])


def read(p: Params, level: str, gates: np.ndarray, at: Steps, trace: dict | None = None) -> np.ndarray:
    """Both directions and attention pooling: one vector per row. ``gates``: (6 hidden, steps)."""
    ways = [] if trace is not None else None
    states = gru(both_ways(gates, at), at, np.stack([p[f"{level}{way}h"] for way in "fb"]), ways)
    states = np.concatenate([states[0], states[1][:, at.turn]])
    u = np.tanh(p[f"{level}a"].T @ states)
    e = np.full(at.mask.shape, -1e9, states.dtype)
    e[at.mask] = p[f"{level}v"] @ u
    a = np.exp(e - e.max(axis=0)) * at.mask
    a /= np.maximum(a.sum(axis=0), np.float32(1e-9))
    a = a[at.mask]
    weighed, pooled = states * a, np.zeros((len(states), at.rows), states.dtype)
    for k, part in at.parts:
        pooled[:, :k] += weighed[:, part]
    if trace is not None:
        trace |= {"ways": ways, "states": states, "u": u, "a": a}
    return pooled.T


def read_back(p: Params, level: str, d_pooled: np.ndarray, at: Steps, trace: dict, grads: Params) -> np.ndarray:
    """Gradients of the input gates (6 hidden, steps)."""
    states, u, a = trace["states"], trace["u"], trace["a"]
    spread = np.take(np.ascontiguousarray(d_pooled.T), at.row, axis=1)
    d_e = a * (spread * states).sum(axis=0)
    d_e -= a * np.bincount(at.row, d_e, at.rows).astype(a.dtype)[at.row]
    grads[f"{level}v"] = u @ d_e
    d_u = (1 - u * u) * p[f"{level}v"][:, None] * d_e
    grads[f"{level}a"] = states @ d_u.T
    d_states = spread * a + p[f"{level}a"] @ d_u
    d_gates, d_recur = gru_back(both_ways(d_states, at), at, trace["ways"], np.stack([p[f"{level}{way}h"] for way in "fb"]))
    for k, way in enumerate("fb"):
        grads[f"{level}{way}h"], grads[f"{level}{way}b"] = d_recur[k], d_gates[k].sum(axis=1)
    return np.concatenate([d_gates[0], d_gates[1][:, at.turn]])


def char_rows(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters (time, rows) as table rows, and lengths. Words have at most ``WORD_CHARS`` characters."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32) % CHAR_ROWS
    out = np.zeros((int(lengths.max(initial=1)), len(words)), np.int64)
    out.T[np.arange(out.shape[0]) < lengths[:, None]] = codes
    return out, lengths


def word_rows(words: Sequence[str]) -> np.ndarray:
    """Table rows by the first letters, a crude stem: inflected and compound words share what is learned."""
    return np.fromiter((zlib.crc32(w[:STEM].encode()) % WORD_ROWS for w in words), np.int64, len(words))


def gates_of(p: Params, level: str, x: np.ndarray) -> np.ndarray:
    """Input gates of both directions (rows, 6 hidden). Equal inputs have equal gates, so these are computed once and looked up."""
    return np.concatenate([x @ p[f"{level}{way}x"] + p[f"{level}{way}b"] for way in "fb"], axis=1)


def gates_back(p: Params, level: str, x: np.ndarray, d_gates: np.ndarray, at: np.ndarray, grads: Params) -> np.ndarray:
    """Gradients of the inputs ``x``, whose numbers at each step are ``at``."""
    d_rows = summed(d_gates, at, len(x)).T
    half = d_rows.shape[1] // 2
    grads[f"{level}fx"], grads[f"{level}bx"] = x.T @ d_rows[:, :half], x.T @ d_rows[:, half:]
    return d_rows[:, :half] @ p[f"{level}fx"].T + d_rows[:, half:] @ p[f"{level}bx"].T


class Scorer:
    """Scores texts; a word's input to the window network is computed once while the bounded memory keeps it."""

    def __init__(self, p: Params) -> None:
        self.p = p
        self.char_gates = np.ascontiguousarray(gates_of(p, "c", p["chars"]).T)
        self.known: dict[str, int] = {}
        self.table = np.zeros((1, 6 * HIDDEN), np.float32)

    def _learn(self, words: list[str]) -> None:
        words.sort(key=len, reverse=True)
        rows = []
        for start in range(0, len(words), GROUP):
            part = words[start : start + GROUP]
            chars, lengths = char_rows(part)
            at = Steps(lengths)
            vectors = read(self.p, "c", np.take(self.char_gates, chars[at.mask], axis=1), at)
            x = np.concatenate([self.p["words"][word_rows(part)], vectors], axis=1)
            rows.append(gates_of(self.p, "w", x))
        self.known |= {w: len(self.table) + k for k, w in enumerate(words)}
        self.table = np.concatenate([self.table, *rows])

    def windows(self, texts: Sequence[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The score of every window, and the text it belongs to."""
        if len(self.known) > CACHE_WORDS:
            self.known, self.table = {}, self.table[:1]
        new = list({w for words in texts for w in words}.difference(self.known))
        if new:
            self._learn(new)
        index, owner, lengths = [], [], []
        known = self.known
        for k, words in enumerate(texts):
            ids = np.fromiter((known[w] for w in words), np.int32, len(words))
            for start in window_starts(len(words)):
                index.append(ids[start : start + WINDOW])
                owner.append(k)
        lengths = np.fromiter(map(len, index), np.int64, len(index))
        order = np.argsort(-lengths, kind="stable")
        scores = np.zeros(len(index), np.float32)
        for start in range(0, len(order), GROUP):
            mine = order[start : start + GROUP]
            at = Steps(lengths[mine])
            ids = np.zeros(at.mask.T.shape, np.int64)
            ids[at.mask.T] = np.concatenate([index[k] for k in mine])
            pooled = read(self.p, "w", np.ascontiguousarray(self.table[ids.T[at.mask]].T), at)
            scores[mine] = sigmoid(pooled @ self.p["out"] + self.p["bias"])
        return scores, np.array(owner)

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        """The highest window score of each text."""
        scores, owner = self.windows([words_of(t) for t in texts])
        out = np.zeros(len(texts))
        np.maximum.at(out, owner, scores)
        return out


def gradients(
    p: Params, windows: Sequence[list[str]], labels: np.ndarray, weights: np.ndarray, rng: np.random.Generator | None = None
) -> tuple[Params, float]:
    order = sorted(range(len(windows)), key=lambda k: -len(windows[k]))
    windows, labels, weights = [windows[k] for k in order], labels[order], weights[order]
    distinct = sorted(sorted({w for words in windows for w in words}), key=len, reverse=True) or [""]
    number = {w: k for k, w in enumerate(distinct)}
    chars, char_lengths = char_rows(distinct)
    rows = word_rows(distinct)
    char_at = Steps(char_lengths)
    chars = chars[char_at.mask]
    char_trace: dict = {}
    vectors = read(p, "c", np.take(gates_of(p, "c", p["chars"]).T, chars, axis=1), char_at, char_trace)
    seen = np.ones((len(rows), 1), np.float32) if rng is None else (rng.random((len(rows), 1)) >= UNKNOWN).astype(np.float32)
    x = np.concatenate([p["words"][rows] * seen, vectors], axis=1)
    at = Steps(np.array([len(w) for w in windows]))
    ids = np.zeros(at.mask.shape, np.int64)
    for k, words in enumerate(windows):
        ids[: len(words), k] = [number[w] for w in words]
    ids = ids[at.mask]
    trace: dict = {}
    pooled = read(p, "w", np.take(gates_of(p, "w", x).T, ids, axis=1), at, trace)
    score = sigmoid(pooled @ p["out"] + p["bias"])
    loss = -float(np.sum(weights * (labels * np.log(score + 1e-7) + (1 - labels) * np.log(1 - score + 1e-7))))
    d = (weights * (score - labels)).astype(np.float32)
    grads: Params = {"out": pooled.T @ d, "bias": d.sum(keepdims=True)}
    d_gates = read_back(p, "w", d[:, None] * p["out"], at, trace, grads)
    d_x = gates_back(p, "w", x, d_gates, ids, grads)
    grads["words"] = summed((d_x[:, :WORD_DIM] * seen).T, rows, len(p["words"])).T
    d_gates = read_back(p, "c", d_x[:, WORD_DIM:], char_at, char_trace, grads)
    grads["chars"] = gates_back(p, "c", p["chars"], d_gates, chars, grads)
    return grads, loss


@dataclass
class Adam:
    rate: float
    step: int = 0

    def __post_init__(self) -> None:
        self.mean: Params = {}
        self.square: Params = {}

    def __call__(self, p: Params, grads: Params) -> None:
        self.step += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        for k, g in grads.items():
            g = g * np.float32(min(1.0, 5.0 / (norm + 1e-9)))
            self.mean[k] = np.float32(0.9) * self.mean.get(k, np.float32(0)) + np.float32(0.1) * g
            self.square[k] = np.float32(0.99) * self.square.get(k, np.float32(0)) + np.float32(0.01) * g * g
            mean, square = self.mean[k] / np.float32(1 - 0.9**self.step), self.square[k] / np.float32(1 - 0.99**self.step)
            p[k] = p[k] - np.float32(self.rate) * mean / (np.sqrt(square) + np.float32(1e-6))


Examples = Sequence[tuple[int, list[list[str]]]]


def highest(p: Params, examples: Examples) -> tuple[np.ndarray, np.ndarray]:
    """For each document its highest window, and that window's score."""
    scores, owner = Scorer(p).windows([w for _, windows in examples for w in windows])
    del owner
    at, best = 0, []
    for _, windows in examples:
        best.append(int(scores[at : at + len(windows)].argmax()))
        at += len(windows)
    starts = np.cumsum([0, *[len(windows) for _, windows in examples[:-1]]])
    return np.array(best), scores[starts + best]


def hold_back(examples: Examples, rng: np.random.Generator) -> tuple[Examples, Examples]:
    """Documents to learn from, and those to look at. With too few of a kind, all serve for both."""
    held: set[int] = set()
    for kind in (0, 1):
        mine = [k for k, (label, _) in enumerate(examples) if label == kind]
        if len(mine) < 2 * HELD:
            return examples, examples
        held.update(rng.permutation(mine)[: len(mine) // HELD].tolist())
    return [e for k, e in enumerate(examples) if k not in held], [examples[k] for k in sorted(held)]


def fit(examples: Examples, steps: int = STEPS, seed: int = 7) -> Params | None:
    """``examples``: label and windows of each document. None where a label is missing."""
    if len({label for label, _ in examples}) < 2:
        return None
    rng, p, adam = np.random.default_rng(seed), init(seed), Adam(RATE)
    share = sum(label for label, _ in examples) / len(examples)
    weight = min(1.0, 2.5 * share / (1 - share))
    examples, held = hold_back(examples, rng)
    held_labels = np.array([label for label, _ in held])

    def held_loss() -> float:
        scores = np.clip(highest(p, held)[1].astype(np.float64), 1e-4, 1 - 1e-4)
        return -float(np.where(held_labels > 0, np.log(scores), weight * np.log(1 - scores)).sum())

    best, lowest = p, np.inf
    while adam.step < steps:
        chosen: list[tuple[int, list[str]]] = []
        if adam.step < WARM:
            few = [e for e in examples if len(e[1]) <= 3] if any(label and len(w) <= 3 for label, w in examples) else examples
            chosen = [(label, w) for label, windows in few for w in windows]
        else:
            for (label, windows), top in zip(examples, highest(p, examples)[0], strict=True):
                chosen.append((label, windows[top]))
                if not label and len(windows) > 1:
                    chosen.append((label, windows[int(rng.integers(len(windows)))]))
        order = rng.permutation(len(chosen))
        for at in range(0, len(order), BATCH):
            if adam.step == steps:
                break
            adam.rate = RATE * (1 if adam.step < 0.75 * steps else 0.25)
            part = [chosen[k] for k in order[at : at + BATCH]]
            labels = np.array([label for label, _ in part], np.float32)
            weights = np.where(labels > 0, np.float32(1), np.float32(weight)) / len(part)
            adam(p, gradients(p, [w for _, w in part], labels, weights, rng)[0])
        if adam.step >= 0.75 * steps:
            loss = held_loss()
            if loss < lowest:
                best, lowest = dict(p), loss
    return best


def training_windows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> list[tuple[int, list[list[str]]]]:
    """All windows of at most ``MAX_TOXIC`` and ``MAX_CLEAN`` documents, picked by a hash of their id."""
    known = labels.where(labels[label_col].isin(0, 1)).select(labels[id_col].alias("label_id"), labels[label_col].cast("int").alias("label"))
    picked = [known.where(F.col("label") == k).orderBy(F.xxhash64("label_id"), "label_id").limit(n) for k, n in ((1, MAX_TOXIC), (0, MAX_CLEAN))]
    sample = F.broadcast(picked[0].union(picked[1]))  # MAX_TOXIC + MAX_CLEAN rows
    texts = docs.select(docs[id_col].alias("row_id"), text_of(docs, text_col).alias("text"))
    rows = texts.join(sample, F.col("row_id") == F.col("label_id")).select(F.col("row_id").cast("string"), "label", "text").distinct()
    earlier = Window.partitionBy("label").orderBy(F.xxhash64("row_id"), "row_id", F.md5("text")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(earlier), F.lit(0))).where(F.col("before") < MAX_BYTES)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                out.append([" ".join(words[s : s + WINDOW]) for s in window_starts(len(words))])
            return pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("label"), pa.array(out, pa.list_(pa.string()))], names=["row_id", "label", "windows"])

        return work

    found = map_slices(rows.select("row_id", "label", "text"), make, "row_id string, label int, windows array<string>").collect()
    word: dict[str, str] = {}  # each word is kept once
    found = sorted((r["row_id"], r["label"], tuple(r["windows"])) for r in found)
    return [(label, [[word.setdefault(w, w) for w in window.split()] for window in windows]) for _, label, windows in found]


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``row_id``, ``row_hash`` and ``score``; the network is fitted to all ``labels`` given, on a bounded sample of them."""
    p = fit(training_windows(docs, labels, id_col, text_col, label_col))
    rows = docs.select(docs[id_col].alias("row_id"), row_hash(docs, id_col, text_col).alias("row_hash"), text_of(docs, text_col).alias("text"))
    id_type = rows.schema["row_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(p)  # fixed size

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        scorer = Scorer(sent.value) if sent.value is not None else lambda texts: np.zeros(len(texts))

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = pa.array(scorer(batch.column("text").to_pylist()), pa.float64())
            return pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("row_hash"), values], names=["row_id", "row_hash", "score"])

        return work

    return map_slices(rows, make, f"row_id {id_type}, row_hash bigint, score double")
