"""Approximate nearest neighbours by largest inner product, from balanced posting lists.

1. Rows that repeat an id and its vector count once.  Of equal vectors only those
   with the smallest ids can be in a result, as ties go to the smaller id; the
   others leave before anything is compared.
2. Largest inner product becomes nearest in one more dimension: x gets
   sqrt(M^2 - |x|^2), M being the largest length, and a query gets 0.
3. A bounded sample is halved again and again along its widest direction, at the
   median, so lists are of equal size.  The means of the last halves are the
   centroids; a graph links each to its nearest others.
4. Every vector goes to the list of its nearest centroid, and a vector near a
   boundary to further ones: those at most ``REPLICA_RATIO`` times as far, unless
   a list it is in already has its centroid nearer to that one.
5. A query searches the graph for all centroids at most ``ratio`` times as far as
   the nearest, and scans their lists.  The ratio is the smallest of a fixed
   ladder that finds ``RECALL`` of the true neighbours of part of the sample.
6. Lists are scanned in blocks of about ``BLOCK`` vectors and ``BLOCK`` queries;
   a task keeps each query's best so far, so what meets in the end is a few rows
   per query and task.  Scores are worked out on the original vectors in double
   precision.

Bounds: the sample has about ``SAMPLE`` vectors, there are at most
``SAMPLE / SAMPLE_PER_LIST`` centroids, and those and their graph are broadcast
(32 MB for vectors of 64 numbers at the most).

Vectors that are null, zero, or hold a null, a NaN or an infinity take no part, nor
do rows without an id, nor vectors of another length than most.  Rows with one id
are each other's own, so none is the other's neighbour, and an id with several
queries is answered for one of them.  With fewer candidates than asked for, all are
returned.  An empty table gives no rows.  Columns other than the two are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docroute.llm.tables import cut_lineage, finished

K = 20
QUERY_STEP = 20
#: Vectors in the sample that the lists are made from, about.
SAMPLE = 65_536
LIST_SIZE = 512
SAMPLE_PER_LIST = 8
DEGREE = 16
REPLICA_RATIO, REPLICAS = 1.02, 4
RECALL = 0.97
LADDER = [1.02, 1.04, 1.06, 1.08, 1.1, 1.12, 1.14, 1.16, 1.18, 1.2, 1.25, 1.3, 1.4, 1.5, 2.0, 1e9]
PROBES = 512
BLOCK = 1024


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (array<float>) of the rows that take part."""
    good = (
        "vec_id IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < float('inf'))"
        " AND exists(embedding, x -> x <> 0)"
    )
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(good)


def first_of_equal(vectors: DataFrame, most: int) -> DataFrame:
    """Of equal vectors the ``most`` smallest ids.  Repeated rows are dropped before
    and after a shuffle by id and vector, which deals a vector of many rows out; of
    what a task then has of it, the ``most`` smallest go on to the next shuffle."""
    rows = vectors.dropDuplicates(["vec_id", "embedding"])
    order = Window.partitionBy("embedding").orderBy("vec_id")
    return rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= most).select("vec_id", "embedding")


def halve(points: np.ndarray, parts: int) -> np.ndarray:
    """The means of ``parts`` equal parts of the points, by halving each along
    the direction in which it is widest."""
    cells = [np.arange(len(points))]
    while len(cells) < parts:
        cells.sort(key=len)
        cell = cells.pop()
        if len(cell) < 2:
            cells.append(cell)
            break
        own = points[cell] - points[cell].mean(0)
        # A few steps of power iteration from the point that is farthest out.
        way = own[np.argmax((own * own).sum(1))]
        for _ in range(8):
            way = own.T @ (own @ way)
            size = np.linalg.norm(way)
            if not size:
                break
            way = way / size
        order = np.argsort(own @ way, kind="stable")
        half = len(cell) // 2
        cells += [cell[order[:half]], cell[order[half:]]]
    return np.stack([points[c].mean(0) for c in cells])


class Centroids:
    """The centroids and a graph of their neighbours, searched in memory."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE):
        self.points = points.astype(np.float32)
        self.square = (self.points.astype(np.float64) ** 2).sum(1).astype(np.float32)
        n = len(points)
        near = []
        for lo in range(0, n, 512):
            d = self._all(self.points[lo : lo + 512])
            d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
            near.append(np.argsort(d, axis=1, kind="stable")[:, : min(degree, n - 1)])
        links = np.concatenate(near)
        # Each also links back and to its successor in order, so all can be reached.
        after = (np.arange(n)[:, None] + 1) % n
        self.links = np.concatenate([links, after, (np.arange(n)[:, None] - 1) % n], axis=1)
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 16)).astype(int))

    def _all(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float32) ** 2).sum(1)[:, None] + self.square - 2 * (x.astype(np.float32) @ self.points.T)

    def near(self, x: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """(within, distance) as arrays (len(x), centroids): those found at most
        ``ratio`` times as far as the nearest found.  A best-first search for all
        rows at once: the nearest centroid not yet opened is opened, as long as it
        is near enough."""
        x = x.astype(np.float32)
        m, n = len(x), len(self.points)
        found = np.full((m, n), np.inf, np.float32)
        closed = np.zeros((m, n), bool)
        square = (x**2).sum(1)

        def look(rows: np.ndarray, cols: np.ndarray) -> None:
            d = square[rows, None] + self.square[cols] - 2 * np.einsum("id,ijd->ij", x[rows], self.points[cols])
            found[rows[:, None], cols] = np.maximum(d, 0)

        live = np.arange(m)
        look(live, np.broadcast_to(self.entries, (m, len(self.entries))))
        limit = np.float32(min(ratio * ratio, 1e18))
        while len(live):
            open_ = np.where(closed[live], np.inf, found[live])
            best = np.argmin(open_, axis=1)
            least = found[live].min(1)
            d = open_[np.arange(len(live)), best]
            go = np.isfinite(d) & (d <= least * limit + 1e-6)
            live, best = live[go], best[go]
            closed[live, best] = True
            if len(live):
                look(live, self.links[best])
        within = found <= found.min(1)[:, None] * limit + 1e-6
        return within & np.isfinite(found), found


def replicas(centroids: Centroids, x: np.ndarray, ratio: float = REPLICA_RATIO, most: int = REPLICAS) -> list[np.ndarray]:
    """The lists of each vector, nearest first."""
    within, far = centroids.near(x, ratio)
    out = []
    for row, d in zip(within, far):
        cols = np.flatnonzero(row)
        chosen: list[int] = []
        for c in cols[np.argsort(d[cols], kind="stable")]:
            apart = ((centroids.points[chosen] - centroids.points[c]) ** 2).sum(1)
            if not (apart < d[c]).any():
                chosen.append(int(c))
            if len(chosen) == most:
                break
        out.append(np.array(chosen))
    return out


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """One more dimension in which all vectors have the same length."""
    rest = np.sqrt(np.maximum(longest**2 - (x.astype(np.float64) ** 2).sum(1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def as_query(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.zeros((len(x), 1), x.dtype)], axis=1)


def fit(sample: np.ndarray, total: int, longest: float, k: int = K, list_size: int = LIST_SIZE, recall: float = RECALL) -> tuple[Centroids, float]:
    """Centroids from the sample, and the ratio that reaches the recall on it."""
    points = lifted(sample, longest)
    lists = max(1, min(total // list_size, len(sample) // SAMPLE_PER_LIST))
    centroids = Centroids(halve(points, lists))
    queries = np.linspace(0, len(sample) - 1, min(PROBES, len(sample))).astype(int)
    k = min(k, len(sample) - 1)
    if not k:
        return centroids, LADDER[-1]
    best = []
    for some in np.array_split(queries, -(-len(queries) // 16)):
        scores = sample[some] @ sample.T
        scores[np.arange(len(some)), some] = -np.inf
        best.append(np.argpartition(-scores, k - 1, axis=1)[:, :k])
    best = np.concatenate(best)
    home: dict[int, list[int]] = {}
    needed = np.unique(best)
    for some in np.array_split(needed, -(-len(needed) // 512)):
        home.update(zip(some.tolist(), (r.tolist() for r in replicas(centroids, points[some]))))
    for ratio in LADDER:
        within, _ = centroids.near(as_query(sample[queries]), ratio)
        hit = [any(w[c] for c in home[v]) for w, row in zip(within, best.tolist()) for v in row]
        if np.mean(hit) >= recall:
            break
    return centroids, ratio


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _best(queries: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of the ``k`` best of a block for each query of a block."""
    rough = q @ x.T
    # Sums in another order differ by less than this.
    error = 4 * q.shape[1] * np.finfo(np.float64).eps * np.sqrt((q * q).sum(1) * (x * x).sum(1).max(initial=0.0))
    rough[queries[:, None] == ids[None, :]] = -np.inf
    k = min(k, len(ids))
    least = -np.partition(-rough, k - 1, axis=1)[:, k - 1] - error
    row, col = np.nonzero((rough >= least[:, None]) & (rough > -np.inf))
    # One dimension after the other, so that equal vectors have equal scores.
    score = np.zeros(len(row))
    for d in range(q.shape[1]):
        score += q[row, d] * x[col, d]
    return queries[row], ids[col], score


def _merged(parts: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    query, vec, score = (np.concatenate(p) for p in zip(*parts))
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1]) | (score[1:] != score[:-1])
    query, vec, score = query[new], vec[new], score[new]
    first = np.searchsorted(query, query)
    top = np.arange(len(query)) - first < k
    return query[top], vec[top], score[top]


@finished
def nearest(vectors: DataFrame, k: int = K, query_step: int = QUERY_STEP, sample: int = SAMPLE, list_size: int = LIST_SIZE, recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest of each vector whose id is divisible by ``query_step``:
    query_id, rank (from 1), vec_id, score."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors).withColumn("size", F.size("embedding"))
    # One row per length of vector.
    sizes = rows.groupBy("size").agg(
        F.count("*").alias("n"),
        F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("square"),
    ).orderBy(F.desc("n"), "size").first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    longest = float(np.sqrt(sizes["square"]))
    rows = rows.filter(F.col("size") == sizes["size"]).select("vec_id", "embedding")
    candidates = cut_lineage(first_of_equal(rows, k + 1))
    total = candidates.count()
    part = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1 << 30)) < int(min(1.0, sample / total) * (1 << 30))
    drawn = candidates.filter(part).orderBy("vec_id").select("embedding").toArrow().column(0).combine_chunks()
    points = _matrix(drawn).astype(np.float64)
    if not len(points):
        points = np.zeros((1, sizes["size"]))
    centroids, ratio = fit(points, total, longest, k, list_size, recall)
    shared = spark.sparkContext.broadcast(centroids)

    def to_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 1024):
                some = batch.slice(lo, 1024)
                lists = replicas(shared.value, lifted(_matrix(some.column("embedding")).astype(np.float64), longest))
                row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                yield _taken(some, row, np.concatenate(lists))

    def to_probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                some = batch.slice(lo, 256)
                within, _ = shared.value.near(as_query(_matrix(some.column("embedding")).astype(np.float64)), ratio)
                row, lists = np.nonzero(within)
                yield _taken(some, row, lists)

    def _taken(some: pa.RecordBatch, row: np.ndarray, lists: np.ndarray) -> pa.RecordBatch:
        at = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [pa.array(lists.astype(np.int32)), some.column("vec_id").take(at), some.column("embedding").take(at)],
            ["list", "vec_id", "embedding"],
        )

    listed = f"list int, vec_id long, embedding {rows.schema['embedding'].dataType.simpleString()}"
    asked = rows.filter(F.col("vec_id") % query_step == 0).dropDuplicates(["vec_id"])

    def blocks(rows: DataFrame, block: str, members: str) -> DataFrame:
        """Lists in blocks of about BLOCK rows: (list, block, members)."""
        # One row per list: bounded by the number of centroids.
        counts = rows.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        placed = rows.join(F.broadcast(counts), "list").withColumn(block, F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
        return placed.groupBy("list", block).agg(
            F.collect_list("vec_id").alias(f"{members}_ids"), F.collect_list("embedding").alias(members)
        )

    posted = cut_lineage(candidates.mapInArrow(to_lists, listed))
    probed = cut_lineage(asked.mapInArrow(to_probes, listed))
    met = blocks(posted, "vector_block", "vectors").join(blocks(probed, "query_block", "queries"), "list")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            query, vec, score = _merged(parts, k)
            return pa.RecordBatch.from_arrays([pa.array(query), pa.array(vec), pa.array(score)], ["query_id", "vec_id", "score"])

        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                queries = one.column("queries_ids").flatten().to_numpy()
                ids = one.column("vectors_ids").flatten().to_numpy()
                q = _matrix(one.column("queries").flatten()).astype(np.float64)
                x = _matrix(one.column("vectors").flatten()).astype(np.float64)
                parts.append(_best(queries, q, ids, x, k))
                size += len(parts[-1][0])
                if size > 2_000_000:
                    parts = [_merged(parts, k)]
                    size = len(parts[0][0])
                    if size > 1_000_000:
                        yield out()
                        parts, size = [], 0
        if parts:
            yield out()

    scanned = met.select("queries_ids", "queries", "vectors_ids", "vectors").mapInArrow(
        scan, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scanned.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH good AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
pairs AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v) AS score
  FROM good q JOIN good x ON x.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM pairs)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""
