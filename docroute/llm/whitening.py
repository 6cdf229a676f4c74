"""Whitening of vectors by shifted Cholesky QR.

The centred vectors are the rows of a tall matrix X.  Its covariance is never
decomposed as such, for forming it squares the condition of X.  Instead X is
orthogonalised in passes over the table:

1. One pass counts the vectors and adds up their entries, in whole numbers.
2. A pass forms the Gram matrix of the rows as they are by then.  Its Cholesky
   factor R, with a shift that keeps it positive, gives the next rows by a
   triangular solve with R.  This is repeated, always from X through all factors
   so far, until the Gram matrix is the identity on the rows' span.
3. The product of the factors times the root of the last Gram matrix has the
   singular values and right singular vectors of X: the components, and their
   variances times n.

A task gives one Gram matrix, whatever it reads, and there are at most ``TASKS``
of them; they are added row by row.  The driver and every task hold matrices of
dimension x dimension, which is the only size that is bounded here
(``DIMENSIONS``), never rows.

Every entry c becomes floor(1024 c) + 100000 first.  A vector takes no part if it
is null or empty, holds a null or an entry that is not finite (or whose 1024-fold
leaves 62 bits), or differs in length from most (ties: the longer length counts).
Repeated rows are rows like any other, and so are those with a null id.  An empty
table gives no rows.  A component without variance (equal vectors, fewer vectors
than dimensions) has ``explained`` 0 and a null ``whitened``; it takes no part in
``identity_error``.  Other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Components that are given.
COMPONENTS = 8
#: Tasks of a pass at most, each of which gives one matrix.
TASKS = 2048
#: Entries of vectors longer than this would not fit a worker as a square matrix.
DIMENSIONS = 8192
#: Entries worked on at a time.
ENTRIES = 1 << 20
#: Passes that orthogonalise, at most; three do where no direction vanishes.
PASSES = 6

_UNIT = np.finfo(np.float64).eps / 2
_LIMIT = 2.0**62


class Vectors:
    """The vectors of a batch that take part: ``rows`` are their places, ``lengths``
    their lengths, and the whole numbers of row i of a length are ``of(length)[i]``."""

    def __init__(self, column: pa.Array):
        if pa.types.is_fixed_size_list(column.type):
            column = column.cast(pa.list_(column.type.value_type))
        ends = column.offsets.to_numpy().astype(np.int64)
        values = column.values.slice(ends[0], ends[-1] - ends[0]).cast(pa.float64())
        ends = ends - ends[0]
        entries = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
        with np.errstate(all="ignore"):
            whole = np.floor(1024.0 * entries)
            odd = ~(np.abs(whole) < _LIMIT)
        before = np.concatenate([[0], np.cumsum(odd)])
        size = np.diff(ends)
        good = (size > 0) & (before[ends[1:]] == before[ends[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
        self.rows = np.flatnonzero(good)
        self.lengths, self.starts = size[good], ends[:-1][good]
        self.whole = np.where(odd, 0, whole)

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, whole numbers) of the vectors of this length."""
        own = self.lengths == length
        at = self.starts[own][:, None] + np.arange(length)
        return self.rows[own], self.whole[at].astype(np.int64) + 100_000


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches, in pieces of about ``ENTRIES`` entries."""
    for batch in batches:
        n = len(batch)
        lengths = pa.compute.list_value_length(batch.column(column))
        total = pa.compute.sum(lengths).as_py() or 0
        step = max(1, n * ENTRIES // max(total, ENTRIES))
        for lo in range(0, n, step):
            yield batch.slice(lo, step)


def _decimals(values) -> list[Decimal | None]:
    return [Decimal(int(v)) if abs(int(v)) < 10**38 else None for v in values]


def fit_list(vectors: DataFrame, column: str) -> tuple[int, int, list[int], int]:
    """(length, n, sums, largest entry) of the vectors that take part."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in slices(batches, column):
            own = Vectors(batch.column(column))
            for length in np.unique(own.lengths).tolist():
                _, x = own.of(length)
                most = int(np.abs(x).max())
                if most * len(x) >= 2**62:
                    x = x.astype(object)
                sums = [int(v) for v in x.sum(axis=0)]
                old = found.setdefault(length, [0, 0, [0] * length])
                found[length] = [old[0] + len(x), max(old[1], most), [a + b for a, b in zip(old[2], sums)]]
        for length, (n, most, sums) in found.items():
            kind = pa.list_(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([length], pa.int32()), pa.array([n], pa.int64()), pa.array([most], pa.int64()), pa.array([_decimals(sums)], kind)],
                ["length", "n", "most", "sums"],
            )

    parts = vectors.select(column).coalesce(TASKS).mapInArrow(count, "length int, n long, most long, sums array<decimal(38,0)>")
    places = parts.select("length", "n", "most", F.posexplode("sums").alias("place", "value"))
    by_place = places.groupBy("length", "place").agg(F.sum("n").alias("n"), F.max("most").alias("most"), F.sum("value").alias("value"))
    by_length = by_place.groupBy("length").agg(
        F.max("n").alias("n"), F.max("most").alias("most"), F.sort_array(F.collect_list(F.struct("place", "value"))).alias("sums")
    )
    best = by_length.orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    if not best:
        return 0, 0, [], 0
    if best[0].length > DIMENSIONS:
        raise ValueError(f"vectors of {best[0].length} entries; at most {DIMENSIONS}")
    return best[0].length, best[0].n, [int(s.value) for s in best[0].sums], best[0].most


class Centred:
    """n times the centred vectors, in whole numbers, and the centred ones."""

    def __init__(self, length: int, n: int, sums: list[int], most: int):
        self.length, self.n = length, n
        # Beyond 62 bits numpy works on Python's numbers.
        kind = np.int64 if 2 * n * (most + 1) < 2**62 else object
        self.sums = np.array(sums, kind)

    def times_n(self, x: np.ndarray) -> np.ndarray:
        return x.astype(self.sums.dtype) * self.n - self.sums

    def of(self, x: np.ndarray) -> np.ndarray:
        return self.times_n(x).astype(np.float64) / self.n


def solve_rows(rows: np.ndarray, r: np.ndarray, width: int = 32) -> np.ndarray:
    """rows R^-1 for an upper triangular R, a block of columns at a time."""
    out = np.empty_like(rows)
    for lo in range(0, rows.shape[1], width):
        hi = min(lo + width, rows.shape[1])
        part = rows[:, lo:hi] - out[:, :lo] @ r[:lo, lo:hi]
        for j in range(lo, hi):
            out[:, j] = (part[:, j - lo] - out[:, lo:j] @ r[lo:j, j]) / r[j, j]
    return out


def gram(vectors: DataFrame, column: str, centred: Centred, size: int, change: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The Gram matrix of the centred rows after ``change``, which gives ``size`` columns."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in slices(batches, column):
            _, x = Vectors(batch.column(column)).of(centred.length)
            rows = change(centred.of(x))
            total += rows.T @ rows
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size, dtype=np.int32)), pa.array(np.full(size, part, np.int32)), pa.array(total.tolist(), pa.list_(pa.float64()))],
            ["i", "part", "row"],
        )

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # the same sum whatever order the parts come in
        rows = np.array(table.column("row").combine_chunks().flatten().to_numpy()).reshape(-1, size)
        return pa.table({"i": table.column("i").slice(0, 1), "row": pa.array([rows.sum(axis=0).tolist()], pa.list_(pa.float64()))})

    parts = vectors.select(column).coalesce(TASKS).mapInArrow(local, "i int, part int, row array<double>")
    out = np.zeros((size, size))
    for row in parts.groupBy("i").applyInArrow(add, "i int, row array<double>").collect():
        out[row.i] = row.row
    return (out + out.T) / 2


def _is_settled(values: np.ndarray) -> bool:
    """Every direction is of length one, or has vanished."""
    return bool(np.all(np.minimum(np.abs(values - 1), np.abs(values)) <= 1e-12 * len(values)))


def shifted_factor(matrix: np.ndarray, n: int, always: bool) -> np.ndarray:
    """The upper Cholesky factor, of the matrix plus a multiple of the identity
    where that is needed to keep it positive."""
    values = np.linalg.eigvalsh(matrix)
    d = len(values)
    shift = 11 * _UNIT * (d * (d + 1) + d * np.sqrt(n)) * values[-1]
    if not always and values[0] > 100 * shift:
        shift = 0.0
    while True:
        try:
            return np.linalg.cholesky(matrix + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 100 * _UNIT * values[-1])


def components(vectors: DataFrame, column: str, centred: Centred) -> tuple[np.ndarray, np.ndarray]:
    """(variances, components as rows) by falling variance."""
    factors: list[np.ndarray] = []

    def orthogonal(rows: np.ndarray) -> np.ndarray:
        for r in factors:
            rows = solve_rows(rows, r)
        return rows

    size = centred.length
    matrix = gram(vectors, column, centred, size, orthogonal)
    composed = np.eye(size)
    while matrix.any() and not _is_settled(np.linalg.eigvalsh(matrix)) and len(factors) < PASSES:
        factors.append(shifted_factor(matrix, centred.n, always=not factors))
        composed = factors[-1] @ composed
        matrix = gram(vectors, column, centred, size, orthogonal)
    values, turned = np.linalg.eigh(matrix)
    root = np.sqrt(np.maximum(values, 0))[:, None] * turned.T
    _, lengths, found = np.linalg.svd(root @ composed)
    # What rounding leaves of a direction without variance.
    lengths = np.where(lengths > 64 * size * _UNIT * lengths[0], lengths, 0)
    signs = np.sign(found[np.arange(size), np.abs(found).argmax(axis=1)])
    return lengths**2 / centred.n, found * signs[:, None]


def whiten(vectors: DataFrame, most: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per vector that takes part and component: the id, component, n,
    deviation (decimal), whitened, explained, identity_error."""
    schema = (
        f"`{id_column}` {vectors.schema[id_column].dataType.simpleString()}, component int, n long,"
        " deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    length, n, sums, largest = fit_list(vectors, column)
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    centred = Centred(length, n, sums, largest)
    variances, found = components(vectors, column, centred)
    k = min(most, length)
    total, live = variances.sum(), int(np.count_nonzero(variances[:k]))
    explained = variances[:k] / total if total else np.zeros(k)
    projection = found[:live].T / np.sqrt(variances[:live])

    error = None
    if live:
        # A column of ones beside them gives their means.
        with_ones = gram(vectors, column, centred, live + 1, lambda x: np.hstack([x @ projection, np.ones((len(x), 1))])) / n
        covariance = with_ones[:live, :live] - np.outer(with_ones[live, :live], with_ones[live, :live])
        error = float(np.abs(covariance - np.eye(live)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            places, x = Vectors(batch.column(column)).of(length)
            if not len(places):
                continue
            off = centred.times_n(x)
            if off.dtype != object and float(np.abs(off).max()) ** 2 * length >= 2.0**62:
                off = off.astype(object)
            squared = (off * off).sum(axis=1)
            exact = pa.decimal128(38, 0)
            deviation = pa.array(_decimals(squared), exact) if off.dtype == object else pa.array(squared).cast(exact)
            white = np.full((len(x), k), np.nan)
            white[:, :live] = centred.of(x) @ projection
            each, m = np.repeat(np.arange(len(x)), k), len(x) * k
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_column).take(pa.array(places[each])),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(m, n, np.int64)),
                    deviation.take(pa.array(each)),
                    pa.array(white.ravel(), mask=np.isnan(white.ravel())),
                    pa.array(np.tile(explained, len(x))),
                    pa.array([error] * m, pa.float64()),
                ],
                [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.select(id_column, column).mapInArrow(project, schema)
