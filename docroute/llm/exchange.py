"""How often does each key of this block of texts occur in the whole corpus?

Several operators need corpus-wide counts of things that are nearly as many as
the words: windows, shingles, n-grams.  As rows, each would cost some thirty
bytes and several microseconds in a shuffle.  Here a block of texts (a few
megabytes, from one input split) sends its distinct keys in sorted runs:

1. ``forward``: a block's keys are parted by the range they fall in ("slice"),
   and each run goes out as one row.  Keys may be cut to a cell of the slice,
   whose count is then an overestimate, as in a count-min sketch.
2. ``returned``: all runs of a slice meet, equal keys are added up, and each
   block gets back a code for each of its keys, in their order.
3. A second pass over the texts forms the same blocks again and reads the codes
   of its split from the shared folder.

A block sends each of its keys once, so a key that a third of all texts hold is
as cheap as any other: nothing is skewed, nothing is broadcast, and the number
of slices grows with the number of shuffle partitions.

Blocks depend on the files and splits that Spark plans.  Operators that work so are
``finished`` (``tables``): their passes are over when they return, and plan the same
splits whatever executors there are; a checksum of the keys guards it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.llm.files import store
from docroute.llm.text import forget, give_back, short_batches
from docroute.llm.tables import cut_lineage, new_folder

#: Bytes of text in a block.
BLOCK_BYTES = 2_000_000
#: Slices per shuffle partition, and how many slices there are at least before
#: there is only one per partition: a block sends a row to each.
SLICES_PER_PARTITION, ENOUGH_SLICES = 4, 1024


def from_files(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """``docs`` itself if it is read from files as it is, with these columns of
    theirs; else written to the shared folder and read from there."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return cut_lineage(docs)
    try:
        docs.select(*columns)
        return docs
    except AnalysisException:
        return cut_lineage(docs)


def with_split(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """The columns of a table of texts, and the input split of each row.  What is
    not read from files as it is gets written to the shared folder first."""
    short_batches(docs.sparkSession)
    split = F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("split")
    return from_files(docs, *columns, split).select(*columns, split)


def blocks(batches: Iterator[pa.RecordBatch], most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(split, number, rows): the rows of each split in blocks of at least
    ``most`` bytes of text, wherever the batches end."""
    forget()
    held: list[pa.RecordBatch] = []
    size, current, number = 0, None, 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=None)[0]

    for batch in batches:
        if not len(batch):
            continue
        splits = batch.column("split").to_numpy()
        sizes = np.asarray(
            pa.compute.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False), np.int64
        )
        lo = 0
        while lo < len(batch):
            if splits[lo] != current:
                if held:
                    yield current, number, joined()
                held, size, current, number = [], 0, splits[lo], 0
            other = np.flatnonzero(splits[lo:] != current)
            end = lo + int(other[0]) if len(other) else len(batch)
            total = size + np.cumsum(sizes[lo:end])
            hi = min(lo + int(np.searchsorted(total, most)) + 1, end)
            held.append(batch.slice(lo, hi - lo))
            size = int(total[hi - lo - 1])
            if size >= most:
                yield current, number, joined()
                held, size, number = [], 0, number + 1
            lo = hi
    if held:
        yield current, number, joined()
    held.clear()
    give_back()


class Slices:
    """``n`` equal ranges of the 64-bit keys."""

    def __init__(self, n: int, cell_bits: int | None = None):
        self.n, self.cell_bits = n, cell_bits
        self.width = -(-(2**64) // n)
        self.lows = [i * self.width for i in range(n)]
        self.shift = max(0, self.width.bit_length() - cell_bits) if cell_bits else 0

    def edges(self, keys: np.ndarray) -> np.ndarray:
        """Where the slices begin in sorted keys, and the end."""
        return np.append(np.searchsorted(keys, np.array(self.lows, np.uint64)), len(keys))

    def cells(self, keys: np.ndarray, i: int) -> np.ndarray:
        return (keys - np.uint64(self.lows[i])) >> np.uint64(self.shift)


def pack_sorted(cells: np.ndarray, wide: bool) -> bytes:
    """Sorted numbers as gaps of two (or four) bytes; larger gaps stand behind."""
    most = 0xFFFFFFFF if wide else 0xFFFF
    gaps = np.diff(cells, prepend=np.uint64(0))
    large = gaps >= most
    return np.where(large, most, gaps).astype("<u4" if wide else "<u2").tobytes() + gaps[large].astype("<u8").tobytes()


def unpack_sorted(raw: bytes, n: int, wide: bool) -> np.ndarray:
    size, most = (4, 0xFFFFFFFF) if wide else (2, 0xFFFF)
    gaps = np.frombuffer(raw, "<u4" if wide else "<u2", n).astype(np.uint64)
    gaps[gaps == most] = np.frombuffer(raw, "<u8", offset=n * size)
    return np.cumsum(gaps, dtype=np.uint64)


def pack_counts(total: np.ndarray) -> np.ndarray:
    """Counts in one byte; those of 255 and more stand behind, in four bytes or eight."""
    large = total[total >= 0xFF]
    larger = large[large >= 0xFFFFFFFF]
    raw = np.minimum(total, 0xFF).astype("u1").tobytes() + np.minimum(large, 0xFFFFFFFF).astype("<u4").tobytes()
    return np.frombuffer(raw + larger.astype("<u8").tobytes(), np.uint8)


def unpack_counts(raw: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(raw, "u1", n).astype(np.int64)
    large = np.flatnonzero(counts == 0xFF)
    counts[large] = np.frombuffer(raw, "<u4", len(large), n)
    larger = large[counts[large] == 0xFFFFFFFF]
    counts[larger] = np.frombuffer(raw, "<u8", len(larger), n + 4 * len(large))
    return counts


RUNS = "slice int, split long, number int, n int, keys binary, more binary"


def run_rows(
    slices: Slices, split: int, number: int, keys: np.ndarray, more: np.ndarray | None = None, wide: bool = False
) -> pa.RecordBatch:
    """The rows that a block sends: its sorted keys, cut to cells if the slices
    have them, and what goes along with each key (its count, or more of its hash)."""
    edges = slices.edges(keys)
    rows = {"slice": [], "n": [], "keys": [], "more": []}
    for i in np.flatnonzero(np.diff(edges)).tolist():
        a, b = int(edges[i]), int(edges[i + 1])
        own = keys[a:b]
        rows["slice"].append(i)
        rows["n"].append(b - a)
        rows["keys"].append(pack_sorted(slices.cells(own, i), wide) if slices.cell_bits else own.astype("<u8").tobytes())
        rows["more"].append(more[a:b].tobytes() if more is not None else None)
    m = len(rows["slice"])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rows["slice"], pa.int32()),
            pa.array([split] * m, pa.int64()),
            pa.array([number] * m, pa.int32()),
            pa.array(rows["n"], pa.int32()),
            pa.array(rows["keys"], pa.binary()),
            pa.array(rows["more"], pa.binary()),
        ],
        ["slice", "split", "number", "n", "keys", "more"],
    )


def summed(keys: np.ndarray, counts: np.ndarray | None, second: np.ndarray | None = None) -> np.ndarray:
    """For every key the sum of the counts (or the number) of its equals."""
    order = np.argsort(keys, kind="stable") if second is None else np.lexsort((second, keys))
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if second is not None:
        ordered = second[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(keys)))
    total = sizes if counts is None else np.add.reduceat(counts[order].astype(np.int64), starts) if len(starts) else sizes
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(total, sizes)
    return out


def returned(
    runs: DataFrame,
    slices: Slices,
    code: Callable[[np.ndarray], np.ndarray],
    more: str | None = None,
    wide: bool = False,
    name: str = "counts",
    totals: bool = False,
) -> str:
    """Add up the runs of each slice and write the codes by split; the folder.

    ``more`` tells what goes along with a key: "count" (uint32), "hash" (uint64,
    the rest of the key) or nothing.  ``code`` maps totals to what a block is
    told about its keys: a number each, or bits.  With ``totals`` (keys that are
    not cut, with counts) the folder also holds what ``distinct_and_sum`` gives.
    """
    spark = runs.sparkSession
    folder = new_folder(spark, name)

    distinct: list[int] = []
    sums: list[int] = []

    def one(rows: list[tuple]) -> list[bytes]:
        sizes = [r[2] for r in rows]
        if slices.cell_bits:
            keys = np.concatenate([unpack_sorted(r[3], r[2], wide) for r in rows])
        else:
            keys = np.concatenate([np.frombuffer(r[3], "<u8") for r in rows])
        extra = None if more is None else np.concatenate([np.frombuffer(r[4], "<u4" if more == "count" else "<u8") for r in rows])
        total = summed(keys, extra if more == "count" else None, extra if more == "hash" else None)
        if totals:
            ordered = np.sort(keys[total > 0])
            distinct.append(int(np.count_nonzero(ordered[1:] != ordered[:-1])) + bool(len(ordered)))
            sums.append(int(extra.sum()))
        at, codes = 0, []
        for n in sizes:
            codes.append(code(total[at : at + n]).tobytes())
            at += n
        return codes

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key: int, rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([key] * len(rows), pa.int32()),
                    pa.array([zlib.crc32(r[3]) for r in rows], pa.int64()),
                    pa.array(one(rows), pa.binary()),
                ],
                ["split", "number", "slice", "check", "codes"],
            )

        forget()
        key, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("slice", "split", "number", "n", "keys", "more")]
            for row in zip(*columns):
                if row[0] != key and held:
                    yield out(key, held)
                    held = []
                key = row[0]
                held.append(row[1:])
        if held:
            yield out(key, held)
        if distinct:
            row = [-1, -1, -1, sum(distinct), struct.pack("<q", sum(sums))]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds)], ["split", "number", "slice", "check", "codes"]
            )

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = runs.repartition(partitions, "slice").sortWithinPartitions("slice")
    codes = met.mapInArrow(merge, "split long, number int, slice int, check long, codes binary")
    codes.repartition("split").write.partitionBy("split").parquet(folder)
    return folder


def distinct_and_sum(spark: SparkSession, folder: str) -> tuple[int, int]:
    """Of all keys: how many have a count above zero, and the sum of the counts."""
    schema = "number int, slice int, check long, codes binary, split long"
    rows = spark.read.schema(schema).parquet(folder).filter("number = -1")
    parts = rows.select("check", "codes").collect()  # one row per shuffle partition
    return sum(r["check"] for r in parts), sum(struct.unpack("<q", r["codes"])[0] for r in parts)


def slices_for(df: DataFrame, cell_bits: int | None = None) -> Slices:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return Slices(partitions * max(1, min(SLICES_PER_PARTITION, ENOUGH_SLICES // partitions)), cell_bits)


class Codes:
    """The codes of one split, read from the shared folder."""

    def __init__(self, folder: str, split: int):
        import pyarrow.parquet as pq
        from pyarrow import fs

        files, root = store(folder)
        self.by: dict[tuple[int, int], tuple[int, bytes]] = {}
        path = f"{root}/split={split}"
        if files.get_file_info(path).type == fs.FileType.NotFound:
            return
        for found in files.get_file_info(fs.FileSelector(path)):
            if found.path.endswith(".parquet"):
                with files.open_input_file(found.path) as file:
                    table = pq.ParquetFile(file).read(["number", "slice", "check", "codes"])
                for number, i, check, codes in zip(*(c.to_pylist() for c in table.columns)):
                    self.by[number, i] = check, codes

    def of(
        self, slices: Slices, number: int, keys: np.ndarray, wide: bool = False, bits: bool = False, dtype=np.uint8, counts: bool = False
    ) -> np.ndarray:
        """The codes of a block's sorted keys, which must be those it sent: numbers,
        bits, or counts from ``pack_counts``."""
        edges = slices.edges(keys)
        out = np.zeros(len(keys), np.int64 if counts else dtype)
        for i in np.flatnonzero(np.diff(edges)).tolist():
            a, b = int(edges[i]), int(edges[i + 1])
            own = keys[a:b]
            sent = pack_sorted(slices.cells(own, i), wide) if slices.cell_bits else own.astype("<u8").tobytes()
            check, codes = self.by.get((number, i), (None, b""))
            if check != zlib.crc32(sent):
                raise RuntimeError("the table's splits are not those of the first pass")
            if counts:
                out[a:b] = unpack_counts(codes, b - a)
                continue
            raw = np.frombuffer(codes, dtype)
            out[a:b] = np.unpackbits(raw, count=b - a) if bits else raw
        return out


class CodesBySplit:
    """Keeps the codes of the split at hand."""

    def __init__(self, folder: str):
        self.folder, self.split, self.codes = folder, None, None

    def __call__(self, split: int) -> Codes:
        if split != self.split:
            self.split, self.codes = split, Codes(self.folder, split)
        return self.codes


def log_code(total: np.ndarray) -> np.ndarray:
    """0 for 1, 1 for 2 and 3, 2 for 4 to 7, and so on."""
    return (np.frexp(total.astype(np.float64))[1] - 1).astype(np.uint8)


def repeated_bits(total: np.ndarray) -> np.ndarray:
    """A bit for each key: whether it was counted more than once."""
    return np.packbits(total > 1)
