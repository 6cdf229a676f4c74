"""Token ids on disk: one wavelet matrix per shard, in one compressed file.

A wavelet matrix keeps a sequence as one bit-plane per bit of its largest value.
The top bits stand in the order of the sequence; for each further plane the
values are parted, stably, by the bit before.  Counts of ones ahead of a place
(``rank``) and places of the k-th one (``select``) on the planes answer, without
decoding the rest: the id at a place, how often an id occurs in a stretch, and
where its k-th occurrence is.

File: magic, length of the header, header (JSON), then compressed parts: the
document ids, their lengths, and every plane in blocks of 2**20 bits.  A reader
decompresses the blocks that a question touches.

``write_shards`` deals the documents out by ranges of their id, sorts each range
and writes it as shards of about four million ids.  A shard has a name of its own
for every attempt, and only shards named in the manifest count, so a lost
executor leaves at most a file that nobody reads.  ``read_documents`` reads the
files back and gives each document its place among all ids.

Null text counts as empty: its end id alone.  Rows with the same id stand next
to each other, ordered by their text; null ids come first.  A text longer than a
shard makes a longer shard.  An empty table gives no shard.  Columns other than
the id and the text are not read.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docroute.llm.files import store
from docroute.llm.text import Texts, short_batches, slices
from docroute.llm.tokenise import encoder
from docroute.llm.tables import cut_lineage
from docroute.sources.documents import shared_folder

MAGIC = b"WVMX0001"
BLOCK_BITS = 1 << 20
SHARD_IDS = 1 << 22
#: Tasks that read shards, at most.
READ_TASKS = 4096
LEVEL = 1


def _zstd():
    import zstandard

    return zstandard


def encode_shard(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    """The file of a sequence of ids and the documents it is made of."""
    compress = _zstd().ZstdCompressor(level=LEVEL).compress
    values = ids.astype(np.uint16 if not len(ids) or int(ids.max()) < 1 << 16 else np.uint32)
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    body, parts = io.BytesIO(), []

    def add(raw: bytes) -> list[int]:
        packed = compress(raw)
        at = body.tell()
        body.write(packed)
        return [at, len(packed)]

    known = np.array([d is not None for d in doc_ids], bool)
    docs = add(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    nulls = add(np.packbits(~known).tobytes())
    sizes = add(np.asarray(lengths, "<i8").tobytes())
    zeros = []
    for level in range(levels - 1, -1, -1):
        ones = ((values >> level) & 1).astype(bool)
        packed = np.packbits(ones)
        blocks = [add(packed[i : i + BLOCK_BITS // 8].tobytes()) for i in range(0, len(packed), BLOCK_BITS // 8)]
        count = [int(np.bitwise_count(packed[i : i + BLOCK_BITS // 8]).sum()) for i in range(0, len(packed), BLOCK_BITS // 8)]
        low = values[~ones]
        zeros.append(len(low))
        parts.append({"blocks": blocks, "ones": count})
        values = np.concatenate((low, values[ones]))
    header = json.dumps(
        {
            "n_ids": len(ids),
            "n_docs": len(doc_ids),
            "levels": levels,
            "zeros": zeros,
            "planes": parts,
            "docs": docs,
            "nulls": nulls,
            "lengths": sizes,
        }
    ).encode()
    return MAGIC + struct.pack("<I", len(header)) + header + body.getvalue()


class _Plane:
    """One bit-plane with rank and select, loaded block by block."""

    def __init__(self, load, part: dict, n: int):
        self.load, self.part, self.n = load, part, n
        self.before = np.concatenate([[0], np.cumsum(part["ones"], dtype=np.int64)])
        self.cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a block, and the ones ahead of each of its 64-byte lines."""
        if i not in self.cache:
            raw = np.frombuffer(self.load(*self.part["blocks"][i]), np.uint8)
            lines = np.add.reduceat(np.bitwise_count(raw), np.arange(0, len(raw), 64), dtype=np.int64)
            self.cache[i] = raw, np.concatenate([[0], np.cumsum(lines)])
        return self.cache[i]

    def bit(self, i: int) -> int:
        raw, _ = self.block(i // BLOCK_BITS)
        i %= BLOCK_BITS
        return int(raw[i >> 3] >> (7 - (i & 7))) & 1

    def rank(self, i: int) -> int:
        """Ones among the first ``i`` bits."""
        b, rest = divmod(i, BLOCK_BITS)
        if not rest:
            return int(self.before[b])
        raw, lines = self.block(b)
        line, byte = rest >> 9, rest >> 3
        n = int(self.before[b] + lines[line]) + int(np.bitwise_count(raw[line * 64 : byte]).sum())
        if rest & 7:
            n += int(raw[byte] >> (8 - (rest & 7))).bit_count()
        return n

    def select(self, bit: int, k: int) -> int:
        """The place of the k-th (from 0) bit of this value."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self.rank(mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def bits(self) -> np.ndarray:
        raw = [np.frombuffer(self.load(*b), np.uint8) for b in self.part["blocks"]]
        packed = np.concatenate(raw) if raw else np.zeros(0, np.uint8)
        return np.unpackbits(packed, count=self.n).view(bool)


class Shard:
    """Questions to one file, given as bytes or as a readable, seekable file."""

    def __init__(self, file: bytes | io.IOBase):
        self.file = io.BytesIO(file) if isinstance(file, bytes) else file
        start = self.file.read(len(MAGIC) + 4)
        if start[: len(MAGIC)] != MAGIC:
            raise ValueError("not a shard file")
        size = struct.unpack("<I", start[len(MAGIC) :])[0]
        self.header = json.loads(self.file.read(size))
        self.base = len(MAGIC) + 4 + size
        self.n, self.levels = self.header["n_ids"], self.header["levels"]
        self.zeros = self.header["zeros"]
        self.planes = [_Plane(self._load, part, self.n) for part in self.header["planes"]]

    def _load(self, at: int, size: int) -> bytes:
        self.file.seek(self.base + at)
        return _zstd().ZstdDecompressor().decompress(self.file.read(size))

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """The document ids, and the numbers of their ids."""
        ids = np.frombuffer(self._load(*self.header["docs"]), "<i8")
        null = np.unpackbits(np.frombuffer(self._load(*self.header["nulls"]), np.uint8), count=len(ids))
        lengths = np.frombuffer(self._load(*self.header["lengths"]), "<i8")
        return [None if x else int(i) for i, x in zip(ids, null)], lengths

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane, zeros in zip(self.planes, self.zeros):
            bit = plane.bit(i)
            value = value << 1 | bit
            i = zeros + plane.rank(i) if bit else i - plane.rank(i)
        return value

    def _stretch(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> self.levels:
            return 0, 0
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            a, b = plane.rank(lo), plane.rank(hi)
            if token >> (self.levels - 1 - level) & 1:
                lo, hi = zeros + a, zeros + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often ``token`` occurs in places lo to hi - 1."""
        lo, hi = self._stretch(token, lo, self.n if hi is None else hi)
        return hi - lo

    def occurrence(self, token: int, k: int) -> int:
        """The place of the k-th (from 0) occurrence of ``token``."""
        lo, hi = self._stretch(token, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - level) & 1
            i = self.planes[level].select(bit, i - self.zeros[level] if bit else i)
        return i

    def ids(self) -> np.ndarray:
        """The whole sequence: the planes are undone from the last to the first."""
        values = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            ones, zeros = self.planes[level].bits(), self.zeros[level]
            values[zeros:] |= values.dtype.type(1 << (self.levels - 1 - level))
            out = np.empty_like(values)
            out[~ones] = values[:zeros]
            out[ones] = values[zeros:]
            values = out
        return values.astype(np.uint32)


MANIFEST = "part int, number int, file string, n_docs long, n_ids long"


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode the texts and write their shards below ``folder``; the manifest has
    one row per shard, in order of (part, number)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, root = store(folder)
        files.create_dir(root, recursive=True)
        part, number = TaskContext.get().partitionId(), 0
        gathered: list[np.ndarray] = []
        names: list[int | None] = []
        lengths: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            ids, sizes = np.concatenate(gathered), np.concatenate(lengths)
            name = f"part-{part:05d}-{number:05d}-{uuid.uuid4().hex}.wvm"
            with files.open_output_stream(f"{root}/{name}") as out:
                out.write(encode_shard(ids, names, sizes))
            row = {"part": part, "number": number, "file": name, "n_docs": len(names), "n_ids": len(ids)}
            number += 1
            for held in (gathered, names, lengths):
                held.clear()
            types = {"part": pa.int32(), "number": pa.int32()}
            columns = [pa.array([v], types.get(k, pa.int64() if isinstance(v, int) else pa.string())) for k, v in row.items()]
            return pa.RecordBatch.from_arrays(columns, list(row))

        for batch in batches:
            for some in slices(batch):
                ids, first = encoder(tokenizer).encode_ended(Texts(some.column("text")), end_id)
                doc_ids, lo = some.column("doc_id").to_pylist(), 0
                while lo < len(doc_ids):
                    room = shard_ids - sum(map(len, gathered))
                    hi = min(int(np.searchsorted(first, first[lo] + room)), len(doc_ids))
                    gathered.append(ids[first[lo] : first[hi]].astype(np.uint32))
                    names.extend(doc_ids[lo:hi])
                    lengths.append(np.diff(first[lo : hi + 1]))
                    lo = hi
                    if sum(map(len, gathered)) >= shard_ids:
                        yield flush()
        if names:
            yield flush()

    short_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranged = rows.repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return cut_lineage(ordered.mapInArrow(write, MANIFEST))


def read_documents(manifest: DataFrame, folder: str, keep_ids: bool = False) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 and, if asked for, ids (binary, uint32)."""
    # Shards are summed up within their part; parts are as many as tasks wrote.
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    parts = parts.select("part", F.coalesce(F.sum("n_ids").over(earlier.orderBy("part")), F.lit(0)).alias("part_base"))
    own = F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    shards = manifest.withColumn("own", own).join(parts, "part").withColumn("base", F.col("part_base") + F.col("own"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                with files.open_input_stream(f"{root}/{name}") as file:
                    shard = Shard(file.read())
                names, lengths = shard.documents()
                ids = shard.ids().astype("<u4")
                first = np.concatenate([[0], np.cumsum(lengths)])
                for lo in range(0, len(names), 1024):
                    hi = min(lo + 1024, len(names))
                    bodies = [ids[a:b].tobytes() for a, b in zip(first[lo:hi].tolist(), first[lo + 1 : hi + 1].tolist())]
                    columns = {
                        "doc_id": pa.array(names[lo:hi], pa.int64()),
                        "start": pa.array(base + first[lo:hi]),
                        "n_tokens": pa.array(lengths[lo:hi]),
                        "ids_crc32": pa.array([zlib.crc32(b) for b in bodies], pa.int64()),
                    }
                    if keep_ids:
                        columns["ids"] = pa.array(bodies, pa.binary())
                    yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    # The rows are tiny, what they name is not: a task for each, up to a number.
    dealt = shards.select("file", "base").repartition(max(1, min(manifest.count(), READ_TASKS)))
    return dealt.mapInArrow(read, schema)


def token_files(
    docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """Write the files and read them back."""
    if folder is None:
        folder = f"{shared_folder(docs.sparkSession)}/docroute-tokens-{uuid.uuid4().hex}"
    return read_documents(write_shards(docs, folder, tokenizer, end_id), folder, keep_ids)
