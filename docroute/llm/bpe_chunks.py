"""Byte-level BPE of whole texts in overlapping chunks.

Long texts are dealt out as overlapping chunks, so one text does not hold up a
task.  Each chunk is cut into pre-tokens on its own.  The first pre-tokens of a
chunk may be wrong, because it begins anywhere, and so may its last ones.  But a
pre-token depends only on the text from its start on: once two tokenisations
share a boundary they agree from there.  Neighbouring chunks are stitched at the
first boundary that both have in their overlap and that follows a character
other than white space; where they share none, pre-tokenising goes on from the
last good boundary until it meets one of the next chunk.  The stretches between
stitches are encoded apart and their ids joined in order.  Decoding joins the
bytes of the ids.

A text of at most ``CHUNK`` characters is one chunk.  Null and empty texts have
no ids.  Texts that are not valid Unicode come as the engine reads them.  Rows
with equal or null ids are encoded as rows of their own; an empty table gives no
rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.llm.text import short_batches
from docroute.llm.tables import cut_lineage

#: Characters in a chunk, and how many of them the next chunk repeats.
CHUNK, OVERLAP = 32_768, 512
#: Characters a pre-token must end ahead of the chunk's end to be trusted: the
#: longest look-ahead of the pattern is the three of a contraction.
MARGIN = 4


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


_ENCODINGS: dict[tuple[str, str], object] = {}


def encoding(path: str, pattern: str):
    """The worker's encoding of a file of ranks, without special tokens."""
    import tiktoken

    key = path, pattern
    if key not in _ENCODINGS:
        _ENCODINGS[key] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={}
        )
    return _ENCODINGS[key]


def boundaries(text: str, pattern) -> list[int]:
    """Where the pre-tokens of a chunk end."""
    return [m.end() for m in pattern.finditer(text)]


def chunk_starts(n: int, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    step = chunk - overlap
    return [0, *range(step, max(n - overlap, 0), step)]


def stitch(text: str, starts: list[int], ends: list[list[int]], pattern, chunk: int = CHUNK) -> list[int]:
    """Places to cut ``text`` at so that its parts, encoded apart, give the ids
    of the whole; ``ends`` has the boundaries of each chunk, from its own start."""
    cuts = [0]
    n = len(text)
    # Boundaries that are surely right, from the chunk that was last stitched.
    sure = [starts[0] + e for e in ends[0]] if ends else []
    limit = min(starts[0] + chunk, n) if starts else 0
    for k in range(1, len(starts)):
        begin, end = starts[k], min(starts[k] + chunk, n)
        own = {begin + e for e in ends[k]}
        trusted = [e for e in sure if max(begin, cuts[-1]) < e <= limit - MARGIN]
        found = next((e for e in trusted if e in own and not text[e - 1].isspace()), None)
        if found is None:
            # Go on from the last good boundary until this chunk's boundaries are met.
            last = max([cuts[-1], *(e for e in sure if e <= limit - MARGIN)])
            for m in pattern.finditer(text, last):
                if m.end() > end - MARGIN:
                    break
                if m.end() in own and m.end() > max(begin, cuts[-1]) and not text[m.end() - 1].isspace():
                    found = m.end()
                    break
        if found is None:
            # No place in all of this chunk: the tokenisation from before runs on.
            sure, limit = [cuts[-1]], cuts[-1] + MARGIN
            continue
        cuts.append(found)
        sure, limit = [e for e in sorted(own) if e >= found], end
    return cuts


def _id_text(ids: list[int], names: list[str]) -> str:
    return ",".join([names[i] for i in ids])


def encode_decode(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, ids (binary, uint32) and decoded (binary)."""
    return _coded(docs, ranks, pattern, chunk, overlap, digests=False)


def encode_digests(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return _coded(docs, ranks, pattern, chunk, overlap, digests=True)


def _coded(docs: DataFrame, ranks: str, pattern: str, chunk: int, overlap: int, digests: bool) -> DataFrame:
    short_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    whole = "doc_id long, n_tokens long, " + (
        "ids_sha256 string, decoded_sha256 string" if digests else "ids binary, decoded binary"
    )

    def result(doc_ids: list, ids_of: Iterator[list[int]]) -> pa.RecordBatch:
        enc = encoding(ranks, pattern)
        names = _names(enc.n_vocab)
        n, first, second = [], [], []
        for ids in ids_of:
            n.append(len(ids))
            if digests:
                first.append(hashlib.sha256(_id_text(ids, names).encode()).hexdigest())
                second.append(hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
            else:
                first.append(np.array(ids, "<u4").tobytes())
                second.append(enc.decode_bytes(ids))
        kind = pa.string() if digests else pa.binary()
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(n, pa.int64()), pa.array(first, kind), pa.array(second, kind)],
            ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])],
        )

    def one_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for batch in batches:
            for lo in range(0, len(batch), 256):
                some = batch.slice(lo, 256)
                texts = some.column("text").to_pylist()
                yield result(some.column("doc_id").to_pylist(), (enc.encode_ordinary(x) for x in texts))

    long = cut_lineage(rows.filter(F.length("text") > chunk).withColumn("row", F.expr("uuid()")))
    short = rows.filter(F.length("text") <= chunk).mapInArrow(one_chunk, whole)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                for k, start in enumerate(chunk_starts(len(text), chunk, overlap)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row]), pa.array([doc], pa.int64()), pa.array([k], pa.int32()), pa.array([start], pa.int64()), pa.array([text[start : start + chunk]])],
                        ["row", "doc_id", "k", "start", "chunk"],
                    )

    def cut_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        compiled = regex.compile(pattern)
        for batch in batches:
            ends = [np.array(boundaries(x, compiled), "<i4").tobytes() for x in batch.column("chunk").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.binary())], [*batch.schema.names, "ends"])

    def stitched(key, group):
        import pandas as pd
        import regex

        group = group.sort_values("k")
        starts = [int(x) for x in group["start"]]
        parts = list(group["chunk"])
        text = "".join(p if i + 1 == len(parts) else p[: starts[i + 1] - starts[i]] for i, p in enumerate(parts))
        ends = [np.frombuffer(e, "<i4").tolist() for e in group["ends"]]
        cuts = stitch(text, starts, ends, regex.compile(pattern), chunk)
        return pd.DataFrame(
            {
                "row": key[0],
                "doc_id": pd.array([group["doc_id"].iloc[0]] * len(cuts), "Int64"),
                "k": np.arange(len(cuts), dtype=np.int32),
                "piece": [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])],
            }
        )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for batch in batches:
            ids = [np.array(enc.encode_ordinary(x), "<u4").tobytes() for x in batch.column("piece").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "doc_id", "k")), pa.array(ids, pa.binary())], ["row", "doc_id", "k", "ids"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column("ids").to_pylist()
            yield result(batch.column("doc_id").to_pylist(), (np.frombuffer(b, "<u4").tolist() for b in bodies))

    chunks = long.mapInArrow(cut, "row string, doc_id long, k int, start long, chunk string")
    tokens = chunks.repartition("row", "k").mapInArrow(
        cut_tokens, "row string, doc_id long, k int, start long, chunk string, ends binary"
    )
    pieces = tokens.groupBy("row").applyInPandas(stitched, "row string, doc_id long, k int, piece string")
    coded = pieces.repartition("row", "k").mapInArrow(encode, "row string, doc_id long, k int, ids binary")
    gathered = (
        coded.groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("parts"))
        .select("doc_id", F.expr("aggregate(parts, CAST('' AS BINARY), (a, p) -> concat(a, p.ids))").alias("ids"))
    )
    return short.union(gathered.mapInArrow(joined, whole))


_NAMES: list[str] = []


def _names(n: int) -> list[str]:
    """The ids as decimal text."""
    while len(_NAMES) < n:
        _NAMES.append(str(len(_NAMES)))
    return _NAMES
