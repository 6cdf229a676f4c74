"""Removal of byte strings that occur more than once, by sorting suffixes.

A window is ``size`` consecutive bytes of one document.  Every byte covered by a
window that also starts anywhere else goes, in all its places.

A suffix array of the whole corpus would move several bytes per byte.  But equal
windows have the same eight-byte word of least hash in the same place (their
"anchor", the first of equals, among those that ``KEY`` bytes of the window
follow).  So windows with one anchor, which lie side by side, form a segment; the
``KEY`` bytes at the anchor are its key, and only segments of one key can share a
window.

1. Every segment goes out as a row: key, hash, place.  Keys are counted.
2. Segments whose key is there more than once are grouped by their hash.  All
   windows of equal segments are repeated, which settles what lies well inside
   copies.
3. Where one key has different segments, one of each is fetched with its bytes,
   and their suffixes are sorted, keys dealt over tasks: by multikey quicksort, a
   word of eight bytes at a time and all groups at once, to a shallow depth; what
   still agrees then is ordered by blind tries, which only look at the words at
   which a group branches.  Neighbours that agree in ``size`` bytes are repeated.
4. A key with more than ``LARGE`` different segments (say, of the places where a
   passage of a third of all documents begins) goes to no single task: its windows
   are counted one by one, by 128 bits of hash.

Counts are added up before they are shuffled, and no group is gathered but those
of step 3.  Segments are told apart by 128 bits of hash, keys by 64, which can only
make a comparison more.

Null text is empty.  Texts shorter than a window are left as they are.  Repeated
rows are documents like any other, so they remove each other.  An empty table gives
no rows.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.llm.tables import cut_lineage, finished
from docroute.llm.text import Texts, mix, ranges, slices

SIZE = 200
#: Bytes from an anchor on that tell segments apart at first.
KEY = 64
#: Window starts worked on at a time, in texts of any length.
STEP = 1 << 21
#: Different segments of a key that one task compares.
LARGE = 4096
#: Words of eight bytes to which multikey quicksort goes.
SHALLOW = 4
#: Bytes of segments whose suffixes are sorted together.
SORTED_BYTES = 4 << 20

_POSITION = np.uint64(0xFFFFFFFF)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, from the running least
    within blocks of that width in both directions."""
    n = len(values) - width + 1
    whole = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    whole[: len(values)] = values
    rows = whole.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(texts: Texts, size: int, key: int, step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, numbers, anchors): windows starts[i] to starts[i] + numbers[i] - 1
    have the anchor anchors[i], all as places in the texts' bytes."""
    width = size - key + 1
    n = texts.n_bytes - size + 1
    for lo in range(0, max(n, 0), step):
        m = min(step, n - lo)
        begin, end = np.maximum(texts.ptr[:-1], lo) - lo, np.minimum(texts.ptr[1:] - size + 1, lo + m) - lo
        own = end > begin
        edge = np.zeros(m + 1, np.int32)
        np.add.at(edge, begin[own], 1)
        np.add.at(edge, end[own], -1)
        starts = np.flatnonzero(np.cumsum(edge[:-1]))
        if not len(starts):
            continue
        grams = np.ndarray((m + width - 1,), "<u8", buffer=texts.data, offset=lo, strides=(1,))
        ranked = (mix(grams.copy()) & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
        anchors = (sliding_least(ranked, width)[starts] & _POSITION).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = anchors[1:] != anchors[:-1]
        first = np.flatnonzero(new)
        yield starts[first] + lo, np.diff(np.append(first, len(starts))), anchors[first] + lo


class SuffixSort:
    """Sorts suffixes that begin at ``places`` of ``data``, within groups, by their
    first ``size`` bytes.  ``data`` has eight bytes more than the suffixes need.

    ``rank`` is each suffix's place in the order, that of its first equal; suffixes
    that are not alone there agree in ``size`` bytes.
    """

    def __init__(self, data: np.ndarray, places: np.ndarray, groups: np.ndarray, size: int, shallow: int = SHALLOW):
        self.view = np.ndarray((len(data) - 7,), ">u8", buffer=data, strides=(1,))
        self.places, self.size = places, size
        words = -(-size // 8)
        self.rank = np.zeros(len(places), np.int64)
        #: Suffixes that are not alone, in order, and the rank of their group.
        self.at = np.argsort(groups, kind="stable")
        self.group = np.zeros(len(places), np.int64)
        self._split(np.ones(len(places), bool), groups[self.at])
        for depth in range(min(shallow, words)):
            self._multikey(depth)
        for depth in range(min(shallow, words), words):
            self._blind(depth)
        self.repeated = np.zeros(len(places), bool)
        self.repeated[self.at] = True

    def _words(self, depth: int) -> np.ndarray:
        found = self.view[self.places[self.at] + 8 * depth].astype(np.uint64)
        beyond = 8 * (depth + 1) - self.size
        return found >> np.uint64(8 * beyond) if beyond > 0 else found

    def _split(self, some: np.ndarray, words: np.ndarray) -> None:
        """Part groups, whose members are in order, where ``words`` changes; then
        leave out suffixes that are alone.  ``some`` marks the groups to part."""
        n = len(self.at)
        if not n:
            return
        new = np.ones(n, bool)
        new[1:] = (self.group[1:] != self.group[:-1]) | (some[1:] & (words[1:] != words[:-1]))
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, n))
        whole = np.ones(n, bool)
        whole[1:] = self.group[1:] != self.group[:-1]
        begin = np.flatnonzero(whole)
        # A part begins as far behind its group's rank as there are members before it.
        rank = self.group[first] + first - begin[np.cumsum(whole)[first] - 1]
        each = np.repeat(rank, sizes)
        self.rank[self.at] = each
        stay = np.repeat(sizes > 1, sizes)
        self.at, self.group = self.at[stay], each[stay]

    def _multikey(self, depth: int) -> None:
        words = self._words(depth)
        order = np.lexsort((words, self.group))
        self.at = self.at[order]
        self._split(np.ones(len(order), bool), words[order])

    def _blind(self, depth: int) -> None:
        """One level of all groups' tries: those that agree in this word skip it,
        the others branch by it."""
        n = len(self.at)
        if not n:
            return
        words = self._words(depth)
        begin = np.flatnonzero(np.concatenate([[True], self.group[1:] != self.group[:-1]]))
        sizes = np.diff(np.append(begin, n))
        branch = np.repeat(np.add.reduceat(words != np.repeat(words[begin], sizes), begin) > 0, sizes)
        if not branch.any():
            return
        own = np.flatnonzero(branch)
        order = np.lexsort((words[own], self.group[own]))
        # A group keeps its stretch, so ordered members go where their group was.
        self.at[own] = self.at[own][order]
        words[own] = words[own][order]
        self._split(branch, words)


def located(docs: DataFrame, *columns: Column) -> DataFrame:
    """These columns, with the ``file`` and ``row`` that each row is read from.  What
    is not read from files is written to the shared folder first."""
    here = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    try:
        return docs.select(*columns, *here)
    except AnalysisException:
        return cut_lineage(docs.select(*columns)).select("*", *here)


_SEGMENT = "file long, row long, start int, n int, key long, seg long"


def _segment_rows(texts: DataFrame, size: int, key: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                own = Texts(some.column("text"))
                for starts, numbers, anchors in segments(own, size, key):
                    doc = np.searchsorted(own.ptr, starts, "right") - 1
                    keys = own.hashes(anchors, anchors + key, seed=3)
                    whole = own.hashes(starts, starts + numbers - 1 + size, seed=4)
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column("file").take(pa.array(doc)),
                            some.column("row").take(pa.array(doc)),
                            pa.array((starts - own.ptr[doc]).astype(np.int32)),
                            pa.array(numbers.astype(np.int32)),
                            pa.array(keys.view(np.int64)),
                            pa.array(whole.view(np.int64)),
                        ],
                        ["file", "row", "start", "n", "key", "seg"],
                    )

    return texts.mapInArrow(rows, _SEGMENT)


_BODY = "file long, row long, start int, n int, settled boolean, key long, body binary, first long, second long"


def _bodies(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The wanted segments with their bytes; of crowded keys, each window with two hashes."""
    lists = wanted.groupBy("file", "row").agg(F.collect_list(F.struct("start", "n", "key", "settled", "crowded")).alias("wanted"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                own, lists = Texts(some.column("text")), some.column("wanted")
                doc = np.repeat(np.arange(len(some)), np.diff(lists.offsets.to_numpy()))
                start, n, key, settled, crowded = (a.to_numpy(zero_copy_only=False) for a in lists.flatten().flatten())
                for crowd in (False, True):
                    at = np.flatnonzero(crowded == crowd)
                    if crowd:
                        offset = ranges(np.zeros(len(at), np.int64), n[at].astype(np.int64))
                        at = np.repeat(at, n[at])
                        starts, length = start[at] + offset, np.ones(len(at), np.int32)
                    else:
                        starts, length = start[at].astype(np.int64), n[at]
                    places = own.ptr[doc[at]] + starts
                    empty = pa.nulls(len(at), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column("file").take(pa.array(doc[at])),
                            some.column("row").take(pa.array(doc[at])),
                            pa.array(starts.astype(np.int32)),
                            pa.array(length.astype(np.int32)),
                            pa.array(settled[at]),
                            pa.array(key[at]),
                            pa.nulls(len(at), pa.binary()) if crowd else _stretches(own.data, places, length + size - 1),
                            *((pa.array(own.hashes(places, places + size, seed).view(np.int64)) if crowd else empty) for seed in (5, 6)),
                        ],
                        ["file", "row", "start", "n", "settled", "key", "body", "first", "second"],
                    )

    return texts.join(lists, ["file", "row"]).select("file", "row", "text", "wanted").mapInArrow(rows, _BODY)


def _stretches(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    sizes = sizes.astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data[ranges(starts, sizes)])])


_SPAN = "file long, row long, lo int, hi int"


def repeated_in(rows: pa.Table, size: int) -> pa.Table:
    """The repeated stretches of segments that are not settled, each compared with
    all of its key."""
    body = rows.column("body").combine_chunks()
    raw = Texts(body)
    start, n, key, settled = (rows.column(c).to_numpy() for c in ("start", "n", "key", "settled"))
    offset = ranges(np.zeros(len(n), np.int64), n.astype(np.int64))
    segment = np.repeat(np.arange(len(n)), n)
    sort = SuffixSort(raw.data, raw.ptr[segment] + offset, key[segment], size)
    found = sort.repeated & ~settled[segment]
    # Neighbouring windows make one stretch.
    edge = np.ones(len(found), bool)
    edge[1:] = segment[1:] != segment[:-1]
    begin = found & (edge | ~np.concatenate([[False], found[:-1]]))
    last = found & (np.append(edge[1:], True) | ~np.append(found[1:], False))
    at, end = np.flatnonzero(begin), np.flatnonzero(last)
    own = pa.array(segment[at])
    lo, hi = start[segment[at]] + offset[at], start[segment[end]] + offset[end] + size
    return pa.table(
        {
            "file": rows.column("file").take(own),
            "row": rows.column("row").take(own),
            "lo": pa.array(lo.astype(np.int32)),
            "hi": pa.array(hi.astype(np.int32)),
        }
    )


def _sorted_spans(bodies: DataFrame, size: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if n > SORTED_BYTES and len(batch):
                # The last key of what is held may go on in this batch.
                more = int(np.searchsorted(batch.column("key").to_numpy(), held[-1].column("key")[-1].as_py(), "right"))
                held.append(batch.slice(0, more))
                batch = batch.slice(more)
                if len(batch):
                    yield from repeated_in(pa.Table.from_batches([h for h in held if len(h)]), size).to_batches()
                    held, n = [], 0
            if len(batch):
                held.append(batch)
                n += batch.column("body").nbytes
        if held:
            yield from repeated_in(pa.Table.from_batches([h for h in held if len(h)]), size).to_batches()

    dealt = bodies.select("file", "row", "start", "n", "settled", "key", "body").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(rows, _SPAN)


@finished
def repeated_spans(docs: DataFrame, size: int = SIZE, key: int = KEY, large: int = LARGE) -> DataFrame:
    """file, row and the stretches (lo, hi) to remove, which may overlap, of every
    row of ``docs`` (as ``located`` gives them) that has any."""
    texts = docs.select("file", "row", "text").filter(F.octet_length("text") >= size)
    rows = cut_lineage(_segment_rows(texts, size, key))
    # Written, so that the join shuffles both sides and can split a key of many rows.
    shared = cut_lineage(rows.groupBy("key").count().filter("count > 1").select("key"))
    suspects = cut_lineage(rows.join(shared, "key"))

    classes = cut_lineage(
        suspects.groupBy("key", "seg").agg(F.count("*").alias("m"), F.min(F.struct("file", "row", "start", "n")).alias("one"))
    )
    several = classes.groupBy("key").agg(F.count("*").alias("d"), F.sum(F.expr("CAST(m = 1 AS INT)")).alias("open"))
    several = several.filter("d > 1 AND open > 0").select("key", (F.col("d") > large).alias("crowded"))
    wanted = classes.join(several, "key").select("one.*", "key", (F.col("m") > 1).alias("settled"), "crowded")
    bodies = cut_lineage(_bodies(texts, wanted, size))

    whole = suspects.join(classes.filter("m > 1").select("key", "seg"), ["key", "seg"]).select(
        "file", "row", F.col("start").alias("lo"), (F.col("start") + F.col("n") + (size - 1)).alias("hi")
    )
    windows = bodies.filter("body IS NULL")
    often = windows.groupBy("first", "second").agg(F.count("*").alias("m"), F.max("settled").alias("known"))
    often = often.filter("m > 1 OR known").select("first", "second")
    crowded = windows.filter("NOT settled").join(often, ["first", "second"]).select(
        "file", "row", F.col("start").alias("lo"), (F.col("start") + size).alias("hi")
    )
    compared = _sorted_spans(bodies.filter("body IS NOT NULL"), size)
    return whole.union(compared).union(crowded).groupBy("file", "row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def remove_repeated_bytes(docs: DataFrame, size: int = SIZE, key: int = KEY, large: int = LARGE, id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: the id, n_bytes, n_removed, n_spans (maximal
    removed runs) and kept (binary: a character may be cut)."""
    rows = located(docs, F.col(id_column).alias("id"), F.col("text"))
    spans = repeated_spans(rows, size, key, large)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                own, lists = Texts(some.column("text")), some.column("spans")
                doc = np.repeat(np.arange(len(some)), np.asarray(lists.value_lengths().fill_null(0)))
                lo, hi = (a.to_numpy(zero_copy_only=False).astype(np.int64) + own.ptr[doc] for a in lists.flatten().flatten())
                edge = np.zeros(own.n_bytes + 1, np.int32)
                np.add.at(edge, lo, 1)
                np.add.at(edge, hi, -1)
                gone = np.cumsum(edge[:-1]) > 0
                before = np.concatenate([[0], np.cumsum(gone)])
                removed = np.diff(before[own.ptr])
                # A run begins behind a byte that stays, or with its text.
                begin = gone.copy()
                begin[1:] &= ~gone[:-1]
                heads = own.ptr[:-1][np.diff(own.ptr) > 0]
                begin[heads] = gone[heads]
                runs = np.diff(np.concatenate([[0], np.cumsum(begin)])[own.ptr])
                left = own.data[: own.n_bytes][~gone]
                ends = (own.ptr - before[own.ptr]).astype(np.int32)
                kept = pa.BinaryArray.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(ends), pa.py_buffer(left)])
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), pa.array(np.diff(own.ptr)), pa.array(removed), pa.array(runs), kept],
                    [id_column, "n_bytes", "n_removed", "n_spans", "kept"],
                )

    schema = f"`{id_column}` {docs.schema[id_column].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary"
    joined = rows.join(spans, ["file", "row"], "left").select("id", "text", "spans")
    return joined.mapInArrow(cut, schema)
