"""Byte-level BPE: encoding by batched numpy merge rounds, and decoding.

All new words of a slice of texts go through the merge rounds together: their symbols lie in one flat array, the ranks
of neighbouring pairs are found by binary search over the sorted pair keys, and every round merges the lowest-ranked
pair of each word. Words seen before in a task are looked up; that memory is bounded by ``CACHE_WORDS``.

Null texts count as empty and give no ids. Repeated rows give repeated results, an empty table an empty one. Only the
named columns of the input are read. Texts may hold the special tokens' strings, which become their ids.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from reportmill.llm.common import map_slices, row_hash, ship_package, text_of

#: Fixed value: how byte-level BPE of this family cuts a text into words.
WORDS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
CACHE_WORDS = 250_000
NONE = np.int64(1 << 62)


def printable_bytes() -> dict[str, int]:
    """The visible character that stands for each byte in the vocabulary file, and the byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Pair keys sorted for binary search, token bytes, and special tokens of a byte-level BPE file."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        model, to_byte = spec["model"], printable_bytes()
        if model["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("a byte-level BPE file without prefix space is needed")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with strip, single_word or normalized flags are not supported")
        ids = model["vocab"]
        self.size = max(max(ids.values()), *special.values(), 0) + 1
        self.token_bytes = [b""] * self.size
        for token, number in ids.items():
            if token not in special:
                self.token_bytes[number] = bytes(to_byte[c] for c in token)
        for token, number in special.items():
            self.token_bytes[number] = token.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)
        self.of_byte = np.zeros(256, np.int64)
        for char, byte in to_byte.items():
            self.of_byte[byte] = ids[char]
        self.special = special
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def encode_words(self, words: Sequence[bytes]) -> list[np.ndarray]:
        """The ids of each word, which has a byte at least."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        rank = np.full(len(symbols), NONE)
        rank[:-1] = np.where(owner[1:] == owner[:-1], self.pair_ranks(symbols[:-1], symbols[1:]), NONE)
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.r_[first, len(symbols)])
            if (lowest == NONE).any():
                over = np.repeat(lowest == NONE, sizes)
                ended = owner[first[lowest == NONE]].tolist()
                ends = np.cumsum(sizes[lowest == NONE])[:-1]
                for word, ids in zip(ended, np.split(symbols[over].astype(np.int32), ends), strict=True):
                    done[word] = ids
                symbols, owner, rank = symbols[~over], owner[~over], rank[~over]
                lowest, sizes = lowest[lowest != NONE], sizes[lowest != NONE]
                if not len(symbols):
                    break
            chosen = rank == np.repeat(lowest, sizes)
            # In a run of equal symbols every pair has the rank; from the left, every other one is merged.
            at = np.flatnonzero(chosen)
            run = np.maximum.accumulate(np.where(np.r_[True, np.diff(at) != 1], np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
            at -= np.arange(len(at))
            # Only pairs that touch a merged symbol have a new rank.
            at = np.unique(np.r_[at, np.maximum(at - 1, 0)])
            right = np.minimum(at + 1, len(symbols) - 1)
            paired = (right > at) & (owner[right] == owner[at])
            rank[at] = np.where(paired, self.pair_ranks(symbols[at], symbols[right]), NONE)
        return done

    def decode(self, ids: Sequence[int]) -> bytes:
        """The tokens' bytes, where not valid UTF-8 replaced as text decoders do."""
        return b"".join([self.token_bytes[i] for i in ids]).decode("utf-8", "replace").encode()


@functools.lru_cache(maxsize=2)
def vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


class Coder:
    """Encodes texts, with a bounded memory of the words it has met."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.ids: dict[str, np.ndarray] = {}
        self.joined: dict[str, str] = {}
        self.shown: dict[str, bytes] = {}

    def _keep(self, word: str, ids: np.ndarray) -> None:
        self.ids[word] = ids
        self.joined[word] = ",".join(map(str, ids.tolist()))
        self.shown[word] = b"".join([self.vocab.token_bytes[i] for i in ids.tolist()])

    def words(self, texts: Sequence[str]) -> list[list[str]]:
        """Each text's words and special tokens, all of them known afterwards."""
        special, out = self.vocab.special, []
        if len(self.ids) > CACHE_WORDS:
            self.ids, self.joined, self.shown = {}, {}, {}
        for token, number in special.items():
            if token not in self.ids:
                self._keep(token, np.array([number], np.int32))
        for text in texts:
            if special and any(token in text for token in special):
                parts = self.vocab.cut.split(text)
                out.append([w for p in parts if p for w in ([p] if p in special else WORDS.findall(p))])
            else:
                out.append(WORDS.findall(text))
        new = list(dict.fromkeys(w for words in out for w in set(words).difference(self.ids)))
        if new:
            for word, ids in zip(new, self.vocab.encode_words([w.encode() for w in new]), strict=True):
                self._keep(word, ids)
        return out


OUTPUTS = {
    "ids": pa.list_(pa.int32()),
    "decoded": pa.string(),
    "ids_sha256": pa.string(),
    "decoded_sha256": pa.string(),
}
_SQL_TYPES = {"ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, path: str, outputs: Sequence[str] = ("ids",), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row_id``, ``row_hash``, ``n_tokens`` and the ``outputs``: ``ids``, the text ``decoded`` from them, or their digests.

    ``path`` is a vocabulary file on the driver; its content, a few MB at any corpus size, is sent to the tasks.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_file(path))
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("row_id"), row_hash(docs, id_col, text_col).alias("row_hash"), text_of(docs, text_col).alias("text"))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        coder = Coder(vocabulary(content.value))

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = coder.words(batch.column("text").to_pylist())
            empty = np.zeros(0, np.int32)
            counts, columns = [], {name: [] for name in outputs}
            for words in texts:
                joined = ",".join([coder.joined[w] for w in words])
                counts.append(joined.count(",") + 1 if joined else 0)
                if "ids" in columns:
                    columns["ids"].append(np.concatenate([coder.ids[w] for w in words]) if words else empty)
                if "ids_sha256" in columns:
                    columns["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                if "decoded" in columns or "decoded_sha256" in columns:
                    shown = b"".join([coder.shown[w] for w in words])
                    if "decoded" in columns:
                        columns["decoded"].append(shown.decode("utf-8", "replace"))
                    if "decoded_sha256" in columns:
                        columns["decoded_sha256"].append(hashlib.sha256(shown.decode("utf-8", "replace").encode()).hexdigest())
            arrays = [batch.column("row_id"), batch.column("row_hash"), pa.array(counts, pa.int64()), *[pa.array(v, OUTPUTS[k]) for k, v in columns.items()]]
            return pa.RecordBatch.from_arrays(arrays, names=["row_id", "row_hash", "n_tokens", *columns])

        return work

    types = ", ".join(f"{name} {_SQL_TYPES[name]}" for name in outputs)
    return map_slices(rows, make, f"row_id {id_type}, row_hash bigint, n_tokens bigint" + (f", {types}" if types else ""))


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of the ids; null ids give null."""
    content = encoded.sparkSession.sparkContext.broadcast(read_file(path))
    names = [c for c in encoded.columns if c != "decoded"]

    def run(batches):
        vocab = vocabulary(content.value)
        for batch in batches:
            texts = [None if ids is None else vocab.decode(ids).decode() for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(texts, pa.string())], names=[*names, "decoded"])

    ship_package(encoded.sparkSession)
    schema = encoded.select(*names).schema.add("decoded", "string")
    return encoded.mapInArrow(run, schema)
