"""Removal of passages that occur more than once, by a count-min prefilter.

A window is ``size`` consecutive words of one document.  Every word covered by a
window whose word sequence also starts anywhere else goes, in all its places.

1. Every block of texts counts its windows into sketches, one per slice of the
   hash space; the sketches of all blocks are merged by slice.  A merged count is
   never too small, so windows counted once are surely unique.
2. Windows estimated to be repeated are grouped exactly, by 128 bits of hash.
   Their number is that of the repeated windows and a few per cent of the others.
3. Windows that are repeated cover their words; the text that is left is formed.

Each pass reads the texts anew; what is exchanged is two bytes per window and
sixteen per suspected one, each key once per block.  Nothing is gathered by
window, so a passage in a third of all documents costs no more than any other.

Null text has no words, nor has one of white space; nothing is removed there.  A
text with fewer words than a window is left as it is.  Repeated rows are
documents like any other, so they remove each other.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docroute.llm import exchange
from docroute.llm.tables import finished
from docroute.llm.text import Texts, Words, ranges, starts_of_runs, windows

SIZE = 35
#: Bits of a cell's number within a slice of the sketch.
CELL_BITS = 26


class _Windows:
    """The windows of a block: their hashes, and the distinct ones in order."""

    def __init__(self, rows: pa.RecordBatch, size: int):
        self.size = size
        self.words = Words(Texts(rows.column("text")))
        hashes = windows(self.words.hashes(), size)
        self.valid = np.flatnonzero(starts_of_runs(self.words.first, size))
        self.hashes = hashes[self.valid]
        order = np.argsort(self.hashes, kind="stable")
        ordered = self.hashes[order]
        # Of equal windows two are sent, which is enough to call them repeated.
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        twice = np.zeros(len(ordered), bool)
        twice[1:] = ~new[1:]
        twice[2:] &= new[1:-1]
        self.sent = order[new | twice]
        self.keys = self.hashes[self.sent]

    def suspected(self, codes: np.ndarray) -> np.ndarray:
        """Of each window, whether its cell was counted more than once."""
        return codes.astype(bool)[np.searchsorted(self.keys, self.hashes)]

    def pairs(self, suspected: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(at, first, second): 128 bits of hash of the suspected windows, in
        order; of equal ones within the block two are kept.  ``at`` maps every
        suspected window to its entry."""
        more = windows(self.words.hashes(seed=1), self.size, seed=2)[self.valid][suspected]
        first = self.hashes[suspected]
        order = np.lexsort((more, first))
        a, b = first[order], more[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        twice = np.zeros(len(a), bool)
        twice[1:] = ~new[1:]
        twice[2:] &= new[1:-1]
        keep = new | twice
        at = np.empty(len(a), np.int64)
        # The entry of the first of its equals.
        at[order] = (np.cumsum(keep) - 1)[np.flatnonzero(new)][np.cumsum(new) - 1] if len(a) else 0
        return at, a[keep], b[keep]


def repeated_words(docs: DataFrame, size: int = SIZE, cell_bits: int = CELL_BITS):
    """Run the two counting passes; gives a function from (split, number, rows)
    of a block to (words, covered), covered telling for each word if it goes."""
    table = exchange.with_split(docs, "text")
    sketch = exchange.slices_for(table, cell_bits)
    exact = exchange.slices_for(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, number, rows in exchange.blocks(batches):
            yield exchange.run_rows(sketch, split, number, _Windows(rows, size).keys)

    estimated = exchange.returned(table.mapInArrow(count, exchange.RUNS), sketch, exchange.repeated_bits, name="sketch")

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = exchange.CodesBySplit(estimated)
        for split, number, rows in exchange.blocks(batches):
            block = _Windows(rows, size)
            told = codes(split).of(sketch, number, block.keys, bits=True)
            _, first, second = block.pairs(block.suspected(told))
            yield exchange.run_rows(exact, split, number, first, second)

    grouped = exchange.returned(
        table.mapInArrow(suspects, exchange.RUNS), exact, exchange.repeated_bits, more="hash", name="windows"
    )

    def covered(by_sketch, by_hash, split: int, number: int, rows: pa.RecordBatch) -> tuple[Words, np.ndarray]:
        block = _Windows(rows, size)
        told = by_sketch(split).of(sketch, number, block.keys, bits=True)
        suspected = block.suspected(told)
        at, first, _ = block.pairs(suspected)
        known = by_hash(split).of(exact, number, first, bits=True)
        starts = block.valid[suspected][known.astype(bool)[at]]
        edge = np.zeros(len(block.words.starts) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + size, -1)
        return block.words, np.cumsum(edge[:-1]) > 0

    return estimated, grouped, covered


def kept_bytes(words: Words, keep: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The kept words of each text, each followed by one space: (bytes, ptr)."""
    starts, sizes = words.starts[keep], (words.ends - words.starts)[keep] + 1
    raw = words.texts.data[ranges(starts, sizes)]
    ends = np.cumsum(sizes)
    raw[ends - 1] = 0x20
    ptr = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(keep)])[words.first]]
    return raw.tobytes(), ptr


@finished
def substring_digests(docs: DataFrame, size: int = SIZE, cell_bits: int = CELL_BITS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    estimated, grouped, covered = repeated_words(docs, size, cell_bits)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_sketch, by_hash = exchange.CodesBySplit(estimated), exchange.CodesBySplit(grouped)
        for split, number, rows in exchange.blocks(batches):
            words, gone = covered(by_sketch, by_hash, split, number, rows)
            raw, ptr = kept_bytes(words, ~gone)
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
            ends = np.maximum(ptr[1:] - 1, ptr[:-1])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(words.counts()),
                    pa.array(removed),
                    pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ptr[:-1].tolist(), ends.tolist())]),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    table = exchange.with_split(docs, F.col("doc_id").cast("long").alias("doc_id"), "text")
    return table.mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


@finished
def remove_repeated(docs: DataFrame, size: int = SIZE, cell_bits: int = CELL_BITS) -> DataFrame:
    """``docs`` without the repeated passages.  A text that loses words becomes
    its other words, joined by one space; the others stay as they are."""
    estimated, grouped, covered = repeated_words(docs, size, cell_bits)
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_sketch, by_hash = exchange.CodesBySplit(estimated), exchange.CodesBySplit(grouped)
        for split, number, rows in exchange.blocks(batches):
            words, gone = covered(by_sketch, by_hash, split, number, rows)
            raw, ptr = kept_bytes(words, ~gone)
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
            texts = [
                raw[a : max(b - 1, a)].decode() if n else old
                for old, n, a, b in zip(
                    rows.column("text").to_pylist(), removed.tolist(), ptr[:-1].tolist(), ptr[1:].tolist()
                )
            ]
            columns = [pa.array(texts, pa.string()) if c == "text" else rows.column(f"c{i}") for i, c in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names)

    own = [F.col("text") if c == "text" else F.col(c).alias(f"c{i}") for i, c in enumerate(names)]
    return exchange.with_split(docs, *own).mapInArrow(cut, StructType(docs.schema.fields))


ORACLE_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM split),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS run FROM starts),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY run) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM repeated),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM split),
left_over AS (
  SELECT e.doc_id, count(g.j) AS n_removed, string_agg(e.word, ' ' ORDER BY e.j) FILTER (WHERE g.j IS NULL) AS kept
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.j = e.j GROUP BY e.doc_id
)
SELECT s.doc_id, len(s.words) AS n_words, coalesce(l.n_removed, 0) AS n_removed, sha256(coalesce(l.kept, '')) AS kept_sha256
FROM split s LEFT JOIN left_over l ON l.doc_id = s.doc_id
"""
