"""Token counts under a unigram model, with one dynamic program over a trie of the pre-tokens.

The distinct pre-tokens of a slice of texts form a trie. Walking it in sorted order computes the best score and token
count of every prefix once, for all the pre-tokens that share it; the counts at the terminal nodes are kept.

A pre-token is a white-space separated word with the word mark in front. A piece's score is ``-log(2 + rank)`` by its
place in the vocabulary; characters without a piece cost one byte token for each UTF-8 byte. Of equal scores, fewer
tokens win. Null and blank texts have no tokens. Repeated rows give repeated results, an empty table an empty one. Only
the named columns of the input are read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from reportmill.llm.common import map_slices, row_hash, text_of

MARK = "▁"
CACHE_WORDS = 300_000


class Unigram:
    """Scores by piece, grouped by nothing but the longest length."""

    def __init__(self, scores: dict[str, float], byte_score: float) -> None:
        self.scores, self.byte_score = scores, byte_score
        self.longest = max(map(len, scores), default=1)

    def count(self, words: Sequence[str]) -> dict[str, int]:
        """Tokens of the best segmentation of each word; words are walked as paths of a trie, shared prefixes once."""
        get, longest, byte_score = self.scores.get, self.longest, self.byte_score
        best, tokens, path, out = [0.0], [0], "", {}
        for word in sorted(set(words)):
            shared = 0
            for a, b in zip(path, word, strict=False):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], tokens[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                size = len(word[end - 1].encode("utf-8", "surrogatepass"))
                top, number = best[end - 1] + size * byte_score, tokens[end - 1] + size
                for start in range(max(0, end - longest), end):
                    score = get(word[start:end])
                    if score is not None:
                        score += best[start]
                        if score > top or score == top and tokens[start] + 1 < number:
                            top, number = score, tokens[start] + 1
                best.append(top)
                tokens.append(number)
            out[word], path = tokens[-1], word
        return out


@functools.lru_cache(maxsize=2)
def unigram(content: bytes) -> Unigram:
    """Pieces of a SentencePiece file in vocabulary order; byte tokens have the score of the last piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(k) for k in range(size) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
    scores = {piece: -math.log(2 + rank) for rank, piece in enumerate(pieces)}
    return Unigram(scores, -math.log(2 + len(pieces)))


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row_id``, ``row_hash``, ``n_words`` and ``n_tokens``. ``path`` is a SentencePiece file on the driver."""
    with open(path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file
    rows = docs.select(docs[id_col].alias("row_id"), row_hash(docs, id_col, text_col).alias("row_hash"), text_of(docs, text_col).alias("text"))
    id_type = rows.schema["row_id"].dataType.simpleString()

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        model = unigram(content.value)
        known: dict[str, int] = {}

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal known
            texts = [text.split() for text in batch.column("text").to_pylist()]
            if len(known) > CACHE_WORDS:
                known = {}
            new = {word for words in texts for word in words}.difference(known)
            known |= {word[1:]: n for word, n in model.count([MARK + word for word in new]).items()}
            sizes = pa.array([len(words) for words in texts], pa.int64())
            tokens = pa.array([sum([known[word] for word in words]) for words in texts], pa.int64())
            return pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("row_hash"), sizes, tokens], names=["row_id", "row_hash", "n_words", "n_tokens"])

        return work

    return map_slices(rows, make, f"row_id {id_type}, row_hash bigint, n_words bigint, n_tokens bigint")
