"""Scoring texts by an n-gram language model of the corpus.

A text's tokens are its words (A-Z in lower case) and one end.  The model is
interpolated from high to low orders with a prior for each context:

    P(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    P(w | h) = (c(h w) + m(h) P(w | h')) / (c(h) + m(h)),   m(h) = RATE * c(h) ** POWER

h' being h without its first word.  m stands for the number of different words
after h, which grows as a power of c(h); since it depends on h alone, every
distribution sums to one, and an unseen context falls back to the shorter one.

Counts are of all training texts.  Words are counted exactly; longer n-grams by
hash cells of 40 bits within a slice (``exchange``).  Only the finished
probabilities are rounded, in the trie.

The model of a corpus does not fit a worker, but the part that a block of texts
asks for does: each block gets the counts of its own n-grams, held-out texts
too, builds them into an Elias-Fano trie in a memory map (``elias_fano``), and is
scored by looking its n-grams up there.  What is exchanged grows with the input,
each n-gram once per block, however frequent.

Null and empty texts, and those of white space, have one token, the end.  A null
id counts as training.  Repeated rows are counted and scored as often as they
occur.  With no training texts all counts are zero.  An empty table gives no
rows.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.llm import elias_fano, exchange
from docroute.llm.tables import finished
from docroute.llm.text import Texts, Words, starts_of_runs, windows

ORDER = 3
PRIOR = 0.1
RATE, POWER = 2.0, 0.9
END = np.uint64(0x0E4DED0E4DED0E4D)
#: Bits of an n-gram's cell within a slice.
CELL_BITS = 40


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))


def eight_bytes(total: np.ndarray) -> np.ndarray:
    return total.astype("<i8")


class _Tokens:
    """The tokens of a block, and its n-grams of each order above one."""

    def __init__(self, rows: pa.RecordBatch, order: int):
        words = Words(Texts(rows.column("text"), lower=True))
        n = len(words.first) - 1
        self.hashes = np.insert(words.hashes(), words.first[1:], END)
        self.first = words.first + np.arange(n + 1)
        self.counts = np.diff(self.first)
        train = ~np.asarray(rows.column("held_out").to_numpy(zero_copy_only=False), bool)
        self.train = np.repeat(train, self.counts)
        self.keys, self.ids = np.unique(self.hashes, return_inverse=True)
        self.order = order
        # Places of the first tokens of all n-grams, and their hashes.
        self.at = [np.flatnonzero(starts_of_runs(self.first, k)) for k in range(2, order + 1)]
        grams = [windows(self.hashes, k, seed=20 + k)[at] for k, at in zip(range(2, order + 1), self.at)]
        joined = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        self.gram_keys, self.gram_ids = np.unique(joined, return_inverse=True)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.ids, self.train, len(self.keys)).astype("<u4")

    def gram_counts(self) -> np.ndarray:
        weights = np.concatenate([self.train[at] for at in self.at]) if self.at else np.zeros(0)
        return np.bincount(self.gram_ids, weights, len(self.gram_keys)).astype("<u4")


def _log10(tokens: _Tokens, words: np.ndarray, grams: np.ndarray, n: int, v: int, rate: float, power: float) -> list[np.ndarray]:
    """For every order, the log10 probabilities of the n-grams at ``tokens.at``
    (of all tokens for order one), given the counts of words and longer n-grams."""
    base = (words + PRIOR) / (n + PRIOR * (v + 1))
    p = base[tokens.ids]
    out = [np.log10(p)]
    context = words[tokens.ids].astype(float)  # the count of the n-gram of order k - 1 that starts at each token
    below = p  # at the n-gram's first token: the probability of its last word in the shorter context
    start = 0
    for k, at in zip(range(2, tokens.order + 1), tokens.at):
        count = grams[tokens.gram_ids[start : start + len(at)]]
        start += len(at)
        c = context[at]
        m = rate * c**power
        shorter = below[at + 1]
        with np.errstate(invalid="ignore", divide="ignore"):
            p = np.where(c > 0, (np.minimum(count, c) + m * shorter) / (c + m), shorter)
        out.append(np.log10(p))
        context, below = np.zeros(len(tokens.hashes)), np.zeros(len(tokens.hashes))
        context[at], below[at] = count, p
    return out


def block_trie(tokens: _Tokens, log10: list[np.ndarray]) -> elias_fano.Writer:
    """The trie of a block's n-grams with their log10 probabilities."""
    return elias_fano.build(tokens.keys, tokens.ids, [np.arange(len(tokens.ids)), *tokens.at], log10)


def text_scores(trie: elias_fano.Trie, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The log10 probability of each text, given its tokens, by the trie: every
    token in the context of up to order - 1 tokens before it."""
    at = [np.flatnonzero(starts_of_runs(first, k)) for k in range(1, trie.order + 1)]
    each = trie.scores(trie.word(hashes), at)
    return np.add.reduceat(each, first[:-1]) if len(first) > 1 else np.zeros(0)


@finished
def score(docs: DataFrame, held: Column | None = None, order: int = ORDER, rate: float = RATE, power: float = POWER) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.  Documents for which ``held`` is true are not learned from."""
    held = held_out() if held is None else held
    table = exchange.with_split(docs, F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held_out"))
    whole = exchange.slices_for(table)
    cells = exchange.slices_for(table, CELL_BITS)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, number, rows in exchange.blocks(batches):
            tokens = _Tokens(rows, 1)
            yield exchange.run_rows(whole, split, number, tokens.keys, tokens.word_counts())

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, number, rows in exchange.blocks(batches):
            tokens = _Tokens(rows, order)
            yield exchange.run_rows(cells, split, number, tokens.gram_keys, tokens.gram_counts(), wide=True)

    words = exchange.returned(
        table.mapInArrow(count_words, exchange.RUNS), whole, eight_bytes, more="count", name="words", totals=True
    )
    grams = exchange.returned(
        table.mapInArrow(count_grams, exchange.RUNS), cells, exchange.pack_counts, more="count", wide=True, name="grams"
    )
    distinct, total = exchange.distinct_and_sum(docs.sparkSession, words)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_word, by_gram = exchange.CodesBySplit(words), exchange.CodesBySplit(grams)
        for split, number, rows in exchange.blocks(batches):
            tokens = _Tokens(rows, order)
            c = by_word(split).of(whole, number, tokens.keys, dtype=np.int64)
            g = by_gram(split).of(cells, number, tokens.gram_keys, wide=True, counts=True)
            log10 = _log10(tokens, c, g, total, distinct, rate, power)
            trie = elias_fano.Trie(block_trie(tokens, log10).buffer())
            at = tokens.first[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("held_out"),
                    pa.array(tokens.counts),
                    pa.array(np.add.reduceat((c > 0)[tokens.ids].astype(np.int64), at)),
                    pa.array(np.full(len(at), total, np.int64)),
                    pa.array(np.add.reduceat(log10[0], at)),
                    pa.array(text_scores(trie, tokens.hashes, tokens.first)),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return table.mapInArrow(
        judge,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
