"""Languages of documents as mixtures, by expectation-maximisation.

Training counts, for every language that labels name, the three-byte grams of
words (ASCII letters in lower case, other bytes as they are, anything else a
space), hashed to 2**16 buckets.  All training documents count; the model is one
row of 2**16 probabilities per language, at most ``MAX_LANGUAGES`` rows or as many
as the caller allows.

A document is a bag of words, each written in one of its languages.  The
likelihood of a word in a language is the product over its grams.
Expectation-maximisation gives the proportions of the languages that make the
document most likely; single words are evidence, so a second language needs no
switch marks.  Then sets of languages of any size compete, each holding the likeliest ones:
one more language must raise the log-likelihood by ``PENALTY`` / 2 * log(number of words).
The answer is the language with the largest proportion in the set that wins, and
the score is that proportion.

Null, empty and very short texts are scored like any other as long as they hold
a letter; without one the language is ``und`` and the score 0.  Labels that are
null are not learned; with no labels at all every document is ``und``, and
``keep_identified`` goes by the letters alone.  Of equal
proportions the language that sorts first wins.  Rows with equal or null ids are
rows of their own (a null id counts as training).  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType, StructField, StructType

from docroute.llm.text import Texts, forget, short_batches, slices

BUCKETS = 1 << 16
MAX_LANGUAGES = 256
#: Added to every count.
SMOOTHING = 0.5
PENALTY = 8.0
#: Steps of expectation-maximisation.
STEPS = 12
UND = "und"
#: Bytes of text worked on at a time; every word has a row of likelihoods.
SLICE_BYTES = 1_000_000

_CLASS = np.full(256, 0x20, np.uint8)
_CLASS[97:123] = np.arange(97, 123)
_CLASS[65:91] = np.arange(97, 123)
_CLASS[0x80:] = np.arange(0x80, 0x100)


class Grams:
    """The grams of the words of some texts: their buckets; the words' places
    among them; the texts' places among the words."""

    def __init__(self, column: pa.Array):
        texts = Texts(column)
        n, ptr = texts.n_bytes, texts.ptr
        data = _CLASS[texts.data[:n]]
        before, after = np.full(n, 0x20, np.uint8), np.full(n, 0x20, np.uint8)
        before[1:], after[:-1] = data[:-1], data[1:]
        filled = np.diff(ptr) > 0
        before[ptr[:-1][filled]] = 0x20
        after[ptr[1:][filled] - 1] = 0x20
        at = np.flatnonzero(data != 0x20)
        value = before[at].astype(np.uint32) | data[at].astype(np.uint32) << 8 | after[at].astype(np.uint32) << 16
        self.buckets = (value * np.uint32(0x9E3779B1)) >> np.uint32(16)
        self.word_at = np.flatnonzero(before[at] == 0x20)
        self.first = np.searchsorted(at[self.word_at], ptr)
        self.texts = len(texts)


def training() -> Column:
    """Documents that may be learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2, F.lit(True))


class Model:
    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        total = counts.sum(1, keepdims=True)
        self.log = np.log((counts + SMOOTHING) / (total + SMOOTHING * BUCKETS)).T.astype(np.float32).copy()


def train(docs: DataFrame, most: int = MAX_LANGUAGES) -> Model:
    """Learn from the rows of ``docs`` whose ``lang`` is not null: ``most`` languages at
    most, each of which is a row of the model (half a megabyte while it is made)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for some in slices(batch, most=SLICE_BYTES):
                grams = Grams(some.column("text"))
                names, which = np.unique(np.array(some.column("lang").to_pylist(), object).astype(str), return_inverse=True)
                ends = np.append(grams.word_at, len(grams.buckets))
                owner = np.repeat(which, np.diff(ends[grams.first]))
                for i, name in enumerate(names):
                    found = np.bincount(grams.buckets[owner == i], minlength=BUCKETS)
                    held[str(name)] = held.get(str(name), 0) + found
        for name, found in held.items():
            some = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(found[some])], ["lang", "bucket", "n"]
            )

    short_batches(docs.sparkSession)
    labelled = docs.select("text", F.col("lang").cast("string").alias("lang")).filter("lang IS NOT NULL")
    counts = labelled.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # At most BUCKETS rows for each of ``most`` languages.
    packed = counts.groupBy("lang").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("n"))
    packed = packed.limit(most + 1).toArrow()
    if len(packed) > most:
        raise ValueError(f"more than {most} languages in the labels")
    order = np.argsort(np.array(packed.column("lang").to_pylist(), object).astype(str), kind="stable")
    names = [packed.column("lang")[int(i)].as_py() for i in order]
    table = np.zeros((len(names), BUCKETS))
    for row, i in enumerate(order.tolist()):
        table[row, packed.column("buckets")[i].values.to_numpy()] = packed.column("n")[i].values.to_numpy()
    return Model(names, table)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows first[i] to first[i + 1] - 1, zero if there are none."""
    out = np.zeros((len(first) - 1, *values.shape[1:]))
    filled = np.flatnonzero(np.diff(first) > 0)
    if len(filled):
        out[filled] = np.add.reduceat(values, first[filled], axis=0)
    return out


def mixtures(model: Model, grams: Grams, penalty: float = PENALTY, steps: int = STEPS) -> np.ndarray:
    """The proportions of all languages in each text; those not in the set are 0."""
    n_words = np.diff(grams.first)
    k = len(model.names)
    log = np.zeros((len(grams.word_at), k))
    if len(grams.word_at):
        log = np.add.reduceat(model.log[grams.buckets], grams.word_at, axis=0).astype(np.float64)
    top = log.max(1, initial=-np.inf, keepdims=True) if len(log) else np.zeros((0, 1))
    word = np.exp(log - top)
    owner = np.repeat(np.arange(grams.texts), n_words)
    alone = _sums(log - top, grams.first)
    texts = np.arange(grams.texts)

    def fit(share: np.ndarray, first: np.ndarray, word: np.ndarray, owner: np.ndarray, steps: int):
        size = np.maximum(np.diff(first), 1)[:, None]
        for _ in range(steps):
            joint = share[owner] * word
            share = _sums(joint / np.maximum(joint.sum(1, keepdims=True), 1e-300), first) / size
        joint = (share[owner] * word).sum(1)
        return share, _sums(np.log(np.maximum(joint, 1e-300)), first)

    best = alone.argmax(1)
    result = np.zeros((grams.texts, k))
    result[texts, best] = n_words > 0
    if k == 1 or not len(log):
        return result
    score = alone[texts, best]
    full, reached = fit(np.full((grams.texts, k), 1.0 / k), grams.first, word, owner, steps)
    # The log-likelihood is concave, so its slope at the full fit bounds that of every set.
    joint = np.maximum((full[owner] * word).sum(1, keepdims=True), 1e-300)
    most = reached + np.maximum(_sums(word / joint, grams.first).max(1) - n_words, 0)
    rank = np.argsort(-full, axis=1, kind="stable")
    price = penalty / 2 * np.log(np.maximum(n_words, 2))
    for size in range(2, k + 1):
        # Only texts in which the next language has a share can gain by it, unless
        # the price of the set is more than any set can gain.
        shared = full[texts, rank[:, size - 1]] * n_words > 1
        if not shared.any():
            break
        some = np.flatnonzero(shared & (most - (size - 1) * price > score))
        if not len(some):
            continue
        words = np.concatenate([np.arange(a, b) for a, b in zip(grams.first[some], grams.first[some + 1])])
        own = np.repeat(np.arange(len(some)), n_words[some])
        first = np.concatenate([[0], np.cumsum(n_words[some])])
        chosen = rank[some, :size]
        share = np.take_along_axis(full[some], chosen, 1)
        share /= share.sum(1, keepdims=True)
        within = np.take_along_axis(word[words], chosen[own], 1)
        share, gained = fit(share, first, within, own, steps // 2)
        gained = gained - (size - 1) * price[some]
        better = gained > score[some]
        result[some[better]] = 0
        result[some[better, None], chosen[better]] = share[better]
        score[some[better]] = gained[better]
    return result


def _letter() -> Column:
    """Whether the text holds a letter."""
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: Model, *columns: str, prefix: str = "") -> DataFrame:
    """``columns`` of ``docs`` with lang_pred, score and mixture (language to
    proportion, of the languages in the set), the three with a prefix to their names."""
    spark = docs.sparkSession
    short_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    names = list(columns)
    added = {"lang_pred": StringType(), "score": DoubleType(), "mixture": MapType(StringType(), DoubleType())}
    schema = StructType([*docs.select(*names).schema.fields, *(StructField(prefix + c, t) for c, t in added.items())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        model = shared.value
        labels = np.array([*model.names, UND], object)
        for batch in batches:
            for some in slices(batch, most=SLICE_BYTES):
                letter = np.asarray(some.column("letter").to_numpy(zero_copy_only=False), bool)
                if model.names:
                    share = mixtures(model, Grams(some.column("text")))
                    # A text whose letters are none that words are made of has no evidence.
                    sure = letter & (share.sum(1) > 0)
                    which = np.where(sure, share.argmax(1), len(model.names))
                    score = np.where(sure, np.clip(share.max(1), 0, 1), 0.0)
                else:
                    share = np.zeros((len(some), 0))
                    which, score = np.zeros(len(some), int), np.zeros(len(some))
                held = [[(model.names[j], float(row[j])) for j in np.flatnonzero(row > 0)] for row in share]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(some.column(f"c{i}") for i in range(len(names))),
                        pa.array(labels[which].tolist(), pa.string()),
                        pa.array(score),
                        pa.array(held, pa.map_(pa.string(), pa.float64())),
                    ],
                    schema.names,
                )

    rows = docs.select("text", _letter().alias("letter"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    return rows.mapInArrow(judge, schema)


def languages(docs: DataFrame, most: int = MAX_LANGUAGES) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, mixture; learned
    from the documents that ``training`` names."""
    model = train(docs.filter(training()), most)
    return identify(docs.withColumn("held_out", ~training()), model, "doc_id", "held_out")


def keep_identified(docs: DataFrame, most: int = MAX_LANGUAGES) -> DataFrame:
    """``docs`` without those that have no language."""
    model = train(docs.filter(training()), most)
    if not model.names:
        # No languages to be told apart, so only texts without letters have none.
        return docs.filter(_letter())
    known = identify(docs, model, *docs.columns, prefix="__")
    return known.filter(F.col("__lang_pred") != UND).select(*docs.columns)
