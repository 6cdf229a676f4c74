"""Words and pieces of a column of texts, as numpy arrays.

The functions take an Arrow string array and work on its bytes, so the cost is a
few nanoseconds a byte and no Python object is made per word.  Texts go through
in slices of a few megabytes, which bounds a task's memory whatever the batch;
a single longer text makes a slice of its own.
"""

from __future__ import annotations

import ctypes
import string
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import SparkSession

#: Bytes of text worked on at a time.
SLICE_BYTES = 2_000_000
#: Rows that go to a Python worker at a time, and their bytes.
BATCH_ROWS, BATCH_BYTES = 1_000, 2_000_000
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: What this worker keeps from one task to the next.
_KEPT: dict[str, object] = {}

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[ord(c) for c in string.punctuation if c != "'"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], np.uint64)

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


class Texts:
    """The bytes of some texts: ``data`` padded by eight zeros, text i being
    data[ptr[i]:ptr[i + 1]].  Null counts as empty."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        if texts.null_count:
            texts = texts.fill_null("")
        wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
        width = np.int64 if wide else np.int32
        _, ends, data = texts.buffers()
        n = len(texts)
        ptr = np.frombuffer(ends, width)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        part = whole[ptr[0] : ptr[-1]]
        self.n_bytes = len(part)
        self.data = np.zeros(len(part) + 8, np.uint8)
        self.data[: len(part)] = _LOWER[part] if lower else part
        self.ptr = ptr - ptr[0]

    def __len__(self) -> int:
        return len(self.ptr) - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of every stretch data[starts[i]:ends[i]]."""
        view = np.ndarray((self.n_bytes + 1,), "<u8", buffer=self.data, strides=(1,))
        size = ends - starts
        h = mix(size.astype(np.uint64) + np.uint64(seed) * _ODD)
        h = mix(h ^ (view[starts] & _MASK[np.minimum(size, 8)]))
        at, done = np.flatnonzero(size > 8), 8
        while len(at):
            rest = size[at] - done
            h[at] = mix(h[at] * _ODD ^ (view[starts[at] + done] & _MASK[np.minimum(rest, 8)]))
            done += 8
            at = at[rest > 8]
        return h

    def bytes_of(self, start: int, end: int) -> bytes:
        return self.data[start:end].tobytes()


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+``, or those that the bytes of ``apart`` part:
    word j is data[starts[j]:ends[j]] and those of text i are first[i] to first[i + 1]."""

    def __init__(self, texts: Texts, apart: np.ndarray = _SPACE):
        n, ptr = texts.n_bytes, texts.ptr
        solid = ~apart[texts.data[:n]]
        begin, end = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        begin[0:n] = solid
        begin[1:n] &= ~solid[:-1]
        end[1:] = solid
        end[1:n] &= ~solid[1:]
        edges = ptr[:-1][np.diff(ptr) > 0]
        begin[edges] = solid[edges]
        inner = edges[edges > 0]
        end[inner] |= solid[inner - 1]
        self.texts = texts
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(end)
        self.first = np.searchsorted(self.starts, ptr)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return self.texts.hashes(self.starts, self.ends, seed)


def windows(hashes: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """A hash of every run of ``size`` consecutive values; entry i is the run
    that starts there (runs across texts are for the caller to leave out)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = pow(int(_ODD) | 1, 2 * seed + 1, 2**64)
    if size <= 8:
        out = hashes[:n].copy()
        for i in range(1, size):
            out = out * np.uint64(factor) + hashes[i : i + n]
    else:
        powers = np.full(len(hashes) + 1, np.uint64(factor))
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        inverse = np.full(n, np.uint64(pow(factor, -1, 2**64)))
        inverse[0] = 1
        inverse = np.cumprod(inverse, dtype=np.uint64)
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * powers[:-1], dtype=np.uint64, out=total[1:])
        out = (total[size:] - total[:n]) * inverse
    return mix(out)


def starts_of_runs(first: np.ndarray, size: int) -> np.ndarray:
    """True for each position at which a run of ``size`` words lies in one text."""
    n = int(first[-1]) - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    ends = np.repeat(first[1:], np.diff(first))
    return np.arange(n) + size <= ends[:n]


#: The last bytes of the white space characters beyond ASCII (fixed values):
#: U+0085 U+00A0 | U+1680 U+2000-200A U+2028 U+2029 U+202F U+205F U+3000
_WIDE_SPACES = (b"\xc2\x85", b"\xc2\xa0")
_WIDER_SPACES = (
    b"\xe1\x9a\x80",
    *(b"\xe2\x80" + bytes([0x80 + i]) for i in range(11)),
    b"\xe2\x80\xa8",
    b"\xe2\x80\xa9",
    b"\xe2\x80\xaf",
    b"\xe2\x81\x9f",
    b"\xe3\x80\x80",
)


def inside(texts: Texts, strings: Sequence[bytes]) -> np.ndarray:
    """The places within an occurrence of one of the strings, but for its first."""
    raw = texts.data[: texts.n_bytes].tobytes()
    found = []
    for string in strings:
        at = raw.find(string)
        while at >= 0:
            found.append(np.arange(at + 1, at + len(string)))
            at = raw.find(string, at + 1)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def pieces(texts: Texts, uncut: Sequence[bytes] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut texts before every ASCII white space that follows a character that
    is none, and before ASCII punctuation (but not an apostrophe) that follows an
    ASCII letter: (starts, ends, first), as in ``Words``.

    Tokenizers whose pre-tokens hold white space only at their front, and letters
    and punctuation together only in contractions, never join text across such a
    place, whatever stands on either side, so the ids of a text are those of its
    pieces, one after the other.  No cut is made within one of the strings ``uncut``.
    """
    n, ptr = texts.n_bytes, texts.ptr
    data = texts.data[:n]
    space = _SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[1:n] = space[1:] & ~space[:-1]
    cut[1:n] |= _PUNCTUATION[data[1:]] & _LETTER[data[:-1]]
    wide = np.flatnonzero(cut[:n] & (np.concatenate([[0], data[:-1]]) >= 0x80)) if n else np.zeros(0, int)
    if len(wide):
        data = data.astype(np.uint32)
        two = data[wide - 2] << 8 | data[wide - 1]
        three = np.where(wide >= 3, data[wide - 3], 0) << 16 | two
        odd = np.isin(two, [int.from_bytes(x) for x in _WIDE_SPACES])
        odd |= np.isin(three, [int.from_bytes(x) for x in _WIDER_SPACES])
        cut[wide[odd]] = False
    if uncut:
        cut[inside(texts, uncut)] = False
    edges = ptr[:-1][np.diff(ptr) > 0]
    cut[edges] = True
    starts = np.flatnonzero(cut[:n])
    ends = np.append(starts[1:], n)
    return starts, ends, np.searchsorted(starts, ptr)


def short_batches(spark: SparkSession) -> None:
    """Have rows with texts go to Python workers in batches of at most
    ``BATCH_ROWS`` from now on, and of about ``BATCH_BYTES`` unless the session says
    otherwise.  The settings are the session's; their defaults of 10,000 rows and
    64 MB would hold tens of megabytes on both sides, several times over, and the
    JVM's allocator keeps a part of what such buffers took."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, BATCH_BYTES)


def give_back() -> None:
    """Return freed memory to the system: a worker that waits for its next task
    shares its executor's memory with others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def kept(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once by a worker and kept until it ``forget``s."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def forget() -> None:
    """Drop what this worker has kept from work of another kind."""
    if _KEPT:
        _KEPT.clear()
        give_back()


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text."""
    texts = batch.column(column)
    if not len(texts):
        return
    size = np.asarray(pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    group = (np.cumsum(size) - size) // most
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for lo, hi in zip(edges, edges[1:]):
        yield batch.slice(lo, hi - lo)
    give_back()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i] to starts[i] + lengths[i] - 1 of all i, in turn."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)
