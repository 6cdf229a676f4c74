"""Best-fit packing planned over a histogram of lengths.

1. Every text is encoded, ended and cut into pieces of at most ``size`` ids; only
   a text longer than that is cut.  A piece is a row without its ids.
2. The pieces are counted by length: at most ``size`` counts, whatever the corpus.
3. The plan is made over the counts.  Lengths go from long to short; all pieces
   of one length go, as many at a time as there are, into the bins with the least
   room that holds them, and then into new bins.  Bins filled alike are one
   entry, so the plan has a few thousand entries for any number of pieces.
4. A slot of the plan is (length, first rank, sequence, offset) for a run of
   ranks.  Pieces take slots by a join on their rank within their length.

Ranks are given without putting one length in one task: pieces are counted by
(length, bucket), the counts are summed up over the buckets, and rows are
numbered within (length, bucket) only.

Null text counts as empty: one end id.  Rows with equal or null ids are packed
as rows of their own.  An empty table gives no rows.  Columns other than the id
and the text are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docroute.llm.text import Texts, short_batches, slices
from docroute.llm.tokenise import encoder
from docroute.llm.tables import cut_lineage, finished

SIZE = 2048
END_ID = 0
#: Buckets within a length in which pieces are numbered apart.
BUCKETS = 1024

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece of every text; ``ids`` (binary, uint32) if asked for."""
    schema = PIECES + (", ids binary" if keep_ids else "")
    short_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids, first = encoder(tokenizer).encode_ended(Texts(part.column("text")), end_id)
                length = np.diff(first)
                n = -(-length // size)
                doc = np.repeat(np.arange(len(length)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * size
                end = np.minimum(start + size, length[doc])
                raw = ids.astype("<u4")
                at = first[doc]
                bodies = [raw[a:b].tobytes() for a, b in zip((at + start).tolist(), (at + end).tolist())]
                columns = [
                    part.column("doc_id").take(pa.array(doc)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(end - start),
                    pa.array([zlib.crc32(b) for b in bodies], pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(bodies, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, ranks, first sequence, offset): the piece of
    ``length`` with rank first + i stands in sequence first sequence + i."""
    bins: dict[int, list[list]] = {}  # room left -> [[number of bins, contents]]
    rooms: list[int] = []

    def put(room: int, number: int, contents: tuple) -> None:
        if room not in bins:
            bisect.insort(rooms, room)
            bins[room] = []
        bins[room].append([number, contents])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            place = bisect.bisect_left(rooms, length)
            if place == len(rooms):
                whole, fits = divmod(left, size // length)
                if whole:
                    put(size % length, whole, (length,) * (size // length))
                if fits:
                    put(size - fits * length, 1, (length,) * fits)
                break
            room = rooms[place]
            entry = bins[room][-1]
            each = min(room // length, max(1, left // entry[0]))
            take = min(entry[0], left // each)
            contents = entry[1] + (length,) * each
            entry[0] -= take
            if not entry[0]:
                bins[room].pop()
                if not bins[room]:
                    del bins[room]
                    rooms.pop(place)
            put(room - each * length, take, contents)
            left -= take * each

    slots, rank, sequence = [], dict.fromkeys(counts, 0), 0
    for room in sorted(bins):
        for number, contents in bins[room]:
            offset = 0
            for length in contents:
                slots.append((length, rank[length], number, sequence, offset))
                rank[length] += number
                offset += length
            sequence += number
    return slots


def _ranked(pieces: DataFrame, buckets: int) -> DataFrame:
    """Pieces with a ``rank`` from 0 within their length."""
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (
        rows.withColumn("within", F.row_number().over(within) - 1)
        .join(bases, ["length", "bucket"])
        .withColumn("rank", F.col("base") + F.col("within"))
        .drop("bucket", "within", "base")
    )


def pack(pieces: DataFrame, size: int = SIZE, buckets: int = BUCKETS) -> DataFrame:
    """Pieces with their place: sequence_id and offset."""
    spark = pieces.sparkSession
    # At most ``size`` rows: one per length.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = _slots(spark, plan(counts, size))
    ranked = _ranked(pieces, buckets)
    # The slots are a few thousand runs; the join is on the length.  A run is found by
    # its rank: first the block of runs, then the run in it.
    at = "size(filter({firsts}, f -> f <= rank)) - 1"
    placed = ranked.join(F.broadcast(slots), "length").withColumn("block", F.expr(f"get(blocks, {at.format(firsts='blocks.first')})"))
    placed = placed.withColumn("run", F.expr(f"get(block.runs, {at.format(firsts='block.runs.first')})"))
    return placed.select(
        *pieces.columns, F.expr("run.sequence + (rank - run.first)").alias("sequence_id"), F.expr("run.offset").alias("offset")
    )


def _slots(spark: SparkSession, slots: list[tuple], block: int = 32) -> DataFrame:
    """One row per length: the runs of its slots in order of rank, in blocks."""
    by: dict[int, list[dict[str, int]]] = {}
    for length, first, _, sequence, offset in slots:
        by.setdefault(length, []).append({"first": first, "sequence": sequence, "offset": offset})
    rows = []
    for length, runs in by.items():
        runs.sort(key=lambda run: run["first"])
        parts = [runs[i : i + block] for i in range(0, len(runs), block)]
        rows.append({"length": length, "blocks": [{"first": part[0]["first"], "runs": part} for part in parts]})
    # An Arrow table, since rows would be converted by Python workers on the executors.
    run = pa.struct([(name, pa.int64()) for name in ("first", "sequence", "offset")])
    blocks = pa.list_(pa.struct([("first", pa.int64()), ("runs", pa.list_(run))]))
    schema = pa.schema([("length", pa.int64()), ("blocks", blocks)])
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


@finished
def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Encode, cut and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(cut_lineage(token_pieces(docs, tokenizer, size, end_id)), size)


def sequences(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """The packed sequences themselves: sequence_id, length, ids (binary, uint32).
    A sequence gathers at most ``size`` ids."""
    packed = pack(cut_lineage(token_pieces(docs, tokenizer, size, end_id, keep_ids=True)), size)
    parts = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    joined = F.expr("aggregate(parts, CAST('' AS BINARY), (a, p) -> concat(a, p.ids))")
    return parts.select("sequence_id", "length", joined.alias("ids"))
