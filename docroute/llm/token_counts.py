"""Token counts of documents under a unigram vocabulary, by a shared trie.

A text's pre-tokens are its words ``[^\\x20\\x09-\\x0D]+``, each with a word mark
ahead of it.  A pre-token's tokens are those of its likeliest segmentation into
vocabulary pieces, the log-probability being the sum over the pieces; characters
that no piece covers fall back to one token a byte.  Among segmentations that are
equally likely the one whose last piece is longest counts, and so on leftwards.

The best score of a prefix does not depend on what follows it.  So the distinct
pre-tokens of a block are put into a trie, and the forward scores (best
log-probability and its number of tokens) are worked out once for each node, that
is once per shared prefix; a word's count is stored at its terminal.  The trie is
walked in order of the sorted words, so only the scores on the path at hand are
held.  A worker remembers the counts of words it has seen, up to a bound.

The public vocabulary file is a list of pieces in order of rank, without
probabilities; ``zipf`` gives each piece one by its rank.

Null and empty texts, and those of white space, have no tokens.  Repeated rows are
counted as often as they occur.  An empty table gives no rows.  Columns other
than the id and the text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.llm.text import Texts, Words, short_batches, slices

MARK = "▁"
#: Distinct words a worker remembers before it starts anew.
KEPT_WORDS = 2_000_000
#: Log-probability of a byte that no piece covers.
BYTE_SCORE = -20.0


def zipf(rank: int) -> float:
    """The log-probability of the piece with this rank (from 0), up to a constant."""
    return -math.log(rank + 2)


def load_pieces(path: str) -> dict[str, float]:
    """The ordinary pieces of a sentencepiece file with their log-probabilities."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    return {piece: zipf(rank) for rank, piece in enumerate(pieces)}


class Vocabulary:
    def __init__(self, pieces: dict[str, float], byte_score: float = BYTE_SCORE):
        self.pieces, self.byte_score = pieces, byte_score
        self.longest = max(map(len, pieces), default=1)
        self.ends: dict[str, list[int]] = {}
        for piece in pieces:
            self.ends.setdefault(piece[-1], []).append(len(piece))
        # By last character: the lengths that pieces ending in it have, long to short.
        self.ends = {c: sorted(set(n), reverse=True) for c, n in self.ends.items()}

    def counts(self, words: list[str]) -> list[int]:
        """The number of tokens of each of the words, which are sorted and distinct."""
        pieces, ends, byte_score = self.pieces, self.ends, self.byte_score
        score, count = [0.0], [0]  # of the prefixes of the word at hand
        out, previous = [], ""
        for word in words:
            shared, most = 0, min(len(word), len(previous))
            while shared < most and word[shared] == previous[shared]:
                shared += 1
            del score[shared + 1 :], count[shared + 1 :]
            for i in range(shared + 1, len(word) + 1):
                last = word[i - 1]
                size = len(last.encode("utf-8", "surrogatepass"))
                best, tokens = score[i - 1] + byte_score * size, count[i - 1] + size
                for length in reversed(ends.get(last, ())):
                    if length > i:
                        break
                    p = pieces.get(word[i - length : i])
                    if p is not None and score[i - length] + p >= best:
                        best, tokens = score[i - length] + p, count[i - length] + 1
                score.append(best)
                count.append(tokens)
            out.append(count[-1])
            previous = word
        return out


class WordCounts:
    """The token counts of words, by their hash, learned as they come."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def of(self, words: Words) -> np.ndarray:
        keys, one, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > KEPT_WORDS:
            self._forget()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            raw = words.texts.data.tobytes()
            at = one[fresh]
            spelled = [
                MARK + raw[a:b].decode("utf-8", "replace")
                for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist())
            ]
            order = sorted(range(len(spelled)), key=spelled.__getitem__)
            values = np.empty(len(fresh), np.int64)
            values[order] = self.vocabulary.counts([spelled[i] for i in order])
            self.keys = np.insert(self.keys, place[fresh], keys[fresh])
            self.values = np.insert(self.values, place[fresh], values)
        return self.values[np.searchsorted(self.keys, keys)[back]]


_COUNTS: dict[str, WordCounts] = {}


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTS:
            _COUNTS[path] = WordCounts(Vocabulary(load_pieces(path)))
        for batch in batches:
            for some in slices(batch):
                words = Words(Texts(some.column("text")))
                total = np.concatenate([[0], np.cumsum(_COUNTS[path].of(words))])
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(words.counts()), pa.array(np.diff(total[words.first]))],
                    ["doc_id", "n_words", "n_tokens"],
                )

    short_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(count, "doc_id long, n_words long, n_tokens long")
