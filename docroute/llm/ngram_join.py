"""Jaccard join of documents on their word n-grams, size-aware.

A document's set holds its distinct shingles of ``SHINGLE`` words (with fewer
words, the whole sequence).  Two sets are linked if 100 * |A & B| >= 75 * |A | B|.
The result is the classes that the links make.

1. Counts.  Every block of texts learns how many documents hold each of its
   shingles (``exchange``; an overestimate by hash cells).  Shingles are ordered
   by that count, rare ones first.  A set of size a may miss a quarter of its
   members in a partner, so one with more members that are surely unique has no
   partner and is done: its document is its own class.
2. Equal sets become one set.
3. Light sets.  If |A & B| >= 3/4 |A| then A and B share k members among the
   first a/4 + k of either, in the common order.  A small set enumerates all
   subsets of k = 2 members of that prefix, and two light sets meet in a subset.
4. Heavy sets.  Subsets of a long prefix are many, so a large set goes by k = 1:
   it scans the inverted lists of its prefix.  Light sets that are near enough in
   size stand in those lists too, to be met by heavy ones.
   The boundary is the size at which subsets and list scans cost least in all,
   summed up from every set's own number of subsets and lengths of lists.
5. Classes.  Of each list, members are first compared with a few others, and what
   is linked becomes one class.  Then a list that still has members of different
   classes needs only its pairs across classes.  A pair is formed only where the
   places of the common member leave enough members behind it to be shared.  A
   list that is long even so is split by a further member, k + 1.  So a list that
   a third of all documents share costs comparisons in proportion to its length.
   Every pair that is formed is checked on the full sets; no link between classes
   is lost.

Sets, shingles and files are told apart by 64 bits of hash.

Null text, empty text and text of white space make an empty set, which is linked
with nothing.  Rows with the same id are rows of their own; null ids come in no
comparison of ids (the smallest of a class is over the others, or null).  An empty
table gives no rows.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.llm import exchange
from docroute.llm.components import components
from docroute.llm.text import Texts, Words, mix, starts_of_runs, windows
from docroute.llm.tables import cut_lineage, finished

SHINGLE = 5
#: Linked if PART * |A & B| >= WHOLE * |A | B|.
PART, WHOLE = 100, 75
CELL_BITS = 26
#: No set above this size is tried as light; subsets of two grow with the square.
LARGEST_LIGHT = 64
#: A list is split by a further member if its pairs across classes may be more
#: than the square of this.
LONG_LIST = 1024
#: Rounds of comparing the members of each list with ends of it, at most, and how
#: many ends a member is compared with in each round.  What links this leaves over
#: is found among the pairs across classes; rounds end when less than one pair in
#: ``FEW_LINKS`` is linked.
STAR_ROUNDS = 6
ENDS = [2, 16, 64]
FEW_LINKS = 10


class Sets:
    """The distinct shingles of each text of a block: those of text i are
    hashes[first[i]:first[i + 1]], in order of their value."""

    def __init__(self, rows: pa.RecordBatch, size: int = SHINGLE):
        words = Words(Texts(rows.column("text"), lower=True))
        hashes, counts = words.hashes(), words.counts()
        valid = np.flatnonzero(starts_of_runs(words.first, size))
        doc = np.repeat(np.arange(len(counts)), counts)
        found, docs = [windows(hashes, size)[valid]], [doc[valid]]
        for k in range(1, size):
            short = np.flatnonzero(counts == k)
            if len(short):
                found.append(windows(hashes, k, seed=10 + k)[words.first[short]])
                docs.append(short)
        values, docs = np.concatenate(found), np.concatenate(docs)
        order = np.lexsort((values, docs))
        values, docs = values[order], docs[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (docs[1:] != docs[:-1])
        self.hashes, self.docs = values[new], docs[new]
        self.first = np.searchsorted(self.docs, np.arange(len(counts) + 1))
        self.keys, self.df = np.unique(self.hashes, return_counts=True)

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)


def allowed_misses(size: np.ndarray) -> np.ndarray:
    """Members a set of this size may lack in a linked one."""
    return size - -(-size * WHOLE // PART)


CANDIDATES = "doc_id long, n long, node long, singles int, subsets double, scans double, body binary"
LOCATOR = "struct<file: bigint, row: bigint>"


def _locator() -> Column:
    """The place a row is read from; the file by its hash."""
    return F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def _candidates(docs: DataFrame, shingle: int, located: bool = False) -> DataFrame:
    """One row per document; those that may be linked have a node (a hash of
    their set) and a body: the shingles in the common order.  If asked for, also
    the locators of the rows."""
    more = {"locator": _locator().alias("locator")} if located else {}
    table = exchange.with_split(docs, F.col("doc_id").cast("long").alias("doc_id"), "text", *more.values())
    slices = exchange.slices_for(table, CELL_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, number, rows in exchange.blocks(batches):
            sets = Sets(rows, shingle)
            yield exchange.run_rows(slices, split, number, sets.keys, sets.df.astype("<u4"))

    counted = exchange.returned(
        table.mapInArrow(count, exchange.RUNS), slices, exchange.log_code, more="count", name="shingles"
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = exchange.CodesBySplit(counted)
        for split, number, rows in exchange.blocks(batches):
            sets = Sets(rows, shingle)
            told = codes(split).of(slices, number, sets.keys)
            code = told[np.searchsorted(sets.keys, sets.hashes)]
            sizes = sets.sizes()
            single = np.concatenate([[0], np.cumsum(code == 0)])
            singles = single[sets.first[1:]] - single[sets.first[:-1]]
            may = (sizes > 0) & (singles <= allowed_misses(sizes))
            # The common order: by count, then by value.
            order = np.lexsort((sets.hashes, code, sets.docs))
            ordered, weight = sets.hashes[order], np.exp2(code[order].astype(float)) * (code[order] > 0)
            weight = np.concatenate([[0], np.cumsum(weight)])
            prefix = np.minimum(allowed_misses(sizes) + 1, sizes)
            scans = weight[sets.first[:-1] + prefix] - weight[sets.first[:-1]]
            longer = np.minimum(prefix + 1, sizes) - np.minimum(singles, prefix)
            subsets = longer * (longer - 1) / 2.0
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets.hashes), dtype=np.uint64)])
            node = mix(total[sets.first[1:]] - total[sets.first[:-1]]).view(np.int64)
            raw = ordered.astype("<u8")
            bodies = [
                raw[a:b].tobytes() if m else None
                for a, b, m in zip(sets.first[:-1].tolist(), sets.first[1:].tolist(), may.tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(sizes),
                    pa.array(node, mask=~may),
                    pa.array(singles.astype(np.int32)),
                    pa.array(subsets),
                    pa.array(scans),
                    pa.array(bodies, pa.binary()),
                    *(rows.column(c) for c in names),
                ],
                ["doc_id", "n", "node", "singles", "subsets", "scans", "body", *names],
            )

    names = list(more)
    return cut_lineage(table.mapInArrow(judge, ", ".join([CANDIDATES, *(f"{c} {LOCATOR}" for c in names)])))


def boundary(costs: list[tuple[int, float, float]]) -> int:
    """The largest light size: ``costs`` has (size, subsets, scans) of the sizes
    up to ``LARGEST_LIGHT``, summed over all sets.  A light set near the boundary
    pays for its place in the lists as well."""
    by = {n: (subsets, scans) for n, subsets, scans in costs}

    def cost(x: int) -> float:
        near = x * WHOLE // PART
        return sum(
            (subsets + (scans if n > near else 0)) if n <= x else scans for n, (subsets, scans) in by.items()
        )

    return min(range(LARGEST_LIGHT + 1), key=cost)


def _few(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in short slices, since each row holds a whole set."""
    for batch in batches:
        for lo in range(0, len(batch), rows):
            yield batch.slice(lo, rows)


LISTS = "sig long, node long, n long, pos int"


def _postings(sets: DataFrame, light: int) -> DataFrame:
    """(sig, node, n, pos): the lists that a set stands in.  Signatures are of
    single members (k = 1) or of two (k = 2); if the signature is the first that
    two sets share, ``pos`` members of either are known not to be shared."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            sigs, places, nodes, sizes, times = [], [], [], [], []
            for node, n, singles, body in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "singles", "body"))):
                if n < 2:
                    continue  # only an equal set can be linked
                members = np.frombuffer(body, "<u8")
                prefix = int(allowed_misses(np.int64(n))) + 1
                if n > light * WHOLE // PART:
                    at = np.arange(min(singles, prefix), prefix)
                    sigs.append(members[at])
                    places.append(at)
                    nodes.append(node)
                    sizes.append(n)
                    times.append(len(at))
                if n <= light:
                    at = np.arange(min(singles, prefix + 1), min(prefix + 1, n))
                    a, b = np.triu_indices(len(at), 1)
                    sigs.append(_two(members[at[a]], members[at[b]]))
                    places.append(at[b] - 1)
                    nodes.append(node)
                    sizes.append(n)
                    times.append(len(a))
            if sigs:
                yield _list_rows(np.concatenate(sigs), np.repeat(nodes, times), np.repeat(sizes, times), np.concatenate(places))

    return sets.select("node", "n", "singles", "body").mapInArrow(post, LISTS)


def _two(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + mix(second))


def _list_rows(sigs: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    columns = [sigs.view(np.int64), nodes.astype(np.int64), sizes.astype(np.int64), places.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sig", "node", "n", "pos"])


def _split_lists(sets: DataFrame, long: DataFrame) -> DataFrame:
    """The lists in ``long`` split by a further member: the sets of such a list
    meet again in a second one after it in the common order."""
    joined = long.join(sets.select("node", "body"), "node")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            sigs, places, nodes, sizes, times = [], [], [], [], []
            for sig, node, n, pos, body in zip(*(batch.column(c).to_pylist() for c in ("sig", "node", "n", "pos", "body"))):
                members = np.frombuffer(body, "<u8")[: int(allowed_misses(np.int64(n))) + 2]
                own = np.array([sig], np.int64).view(np.uint64)
                # A list of two members already is left as it is.
                single = pos < len(members) and members[pos] == own[0]
                at = np.arange(pos + 1, len(members)) if single else np.array([pos + 1])
                sigs.append(_two(np.repeat(own, len(at)), members[at]) if single else own)
                places.append(at - 1)
                nodes.append(node)
                sizes.append(n)
                times.append(len(at))
            if sigs:
                yield _list_rows(np.concatenate(sigs), np.repeat(nodes, times), np.repeat(sizes, times), np.concatenate(places))

    return joined.select("sig", "node", "n", "pos", "body").mapInArrow(split, LISTS)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v, linked) of pairs (u, v), on the full sets."""
    left = sets.select(F.col("node").alias("u"), F.col("body").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("body").alias("b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            linked = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                both = np.sort(np.concatenate([a, b]))
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                linked.append(PART * common >= WHOLE * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(linked, pa.bool_())], ["u", "v", "linked"])

    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(check, "u long, v long, linked boolean")


#: What two sets can share at most, if they share nothing ahead of their places.
_NEAR = f"{PART + WHOLE} * least(n - pos, n2 - pos2) >= {WHOLE} * (n + n2)"
#: The same, with the smallest set of the list for the other.
_ABLE = f"{PART + WHOLE} * (n - pos) >= {WHOLE} * (n + least_n)"


def _classed(lists: DataFrame, classes: DataFrame | None) -> DataFrame:
    """The members of lists that hold more than one class, with their class;
    without members that no set of the list can be near enough to."""
    if classes is None:
        rows = lists.withColumn("class", F.col("node"))
    else:
        rows = lists.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    least = rows.groupBy("sig").agg(F.min("n").alias("least_n"), F.min("class").alias("low"), F.max("class").alias("high"))
    able = rows.join(least.filter("low <> high").select("sig", "least_n"), "sig").filter(_ABLE)
    mixed = able.groupBy("sig").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high")
    return able.join(mixed.select("sig"), "sig").select("sig", "node", "n", "pos", "class")


def _largest(rows: DataFrame) -> DataFrame:
    """(sig, largest): the class that most members of a list are in."""
    sizes = rows.groupBy("sig", "class").agg(F.count("*").alias("members"))
    return sizes.groupBy("sig").agg(F.max_by("class", "members").alias("largest"))


def _star_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs of each member with ends of its lists, those it shares most lists
    with.  An end of a list is the member of its largest class with the fewest
    members ahead of the common one, which is near to many; later also others of
    that class, different ones for each list and turn."""
    few = ENDS[min(turn, len(ENDS) - 1)]
    from_class = rows if not turn else rows.join(_largest(rows), "sig").filter("class = largest")

    def end(*order: Column) -> Column:
        own = [F.col("node").alias("v"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("class").alias("class2")]
        return F.struct(F.struct(*order).alias("place"), *own)

    chosen = [F.min(end(F.col("pos"), F.col("node")))]
    for k in range(2 * turn):
        place = end(F.hash("sig", "node", F.lit(turn), F.lit(k)).alias("pos"), F.col("node"))
        chosen.append(F.min(place))
    ends = from_class.groupBy("sig").agg(F.array(*chosen).alias("ends")).select("sig", F.inline("ends"))
    met = rows.join(ends, "sig").filter(F.col("class") != F.col("class2")).filter(_NEAR)
    shared = met.select(F.col("node").alias("u"), "v").groupBy("u", "v").agg(F.count("*").alias("times"))
    # A member has a few ends for each member of its prefix at most.
    best = Window.partitionBy("u").orderBy(F.desc("times"), "v")
    return shared.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= few).select("u", "v")


def _cross_pairs(rows: DataFrame, tried: DataFrame) -> DataFrame:
    """All pairs of a list's members of different classes that can be near
    enough and were not tried.  Members outside a list's largest class are met
    with all; those inside it never with each other."""
    others = rows.join(_largest(rows), "sig").filter(F.col("class") != F.col("largest"))
    right = rows.select(
        "sig", F.col("node").alias("v"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("class").alias("class2")
    )
    met = others.join(right, "sig").filter("class < class2 OR (class <> class2 AND class2 = largest)").filter(_NEAR)
    pairs = met.select(F.least("node", "v").alias("u"), F.greatest("node", "v").alias("v")).distinct()
    done = tried.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    return pairs.join(done, ["u", "v"], "left_anti")


def _work(rows: DataFrame) -> DataFrame:
    """(sig, pairs): how many pairs across classes a list has, about."""
    sizes = rows.groupBy("sig", "class").agg(F.count("*").alias("members"))
    lists = sizes.groupBy("sig").agg(F.sum("members").alias("m"), F.max("members").alias("largest"))
    return lists.select("sig", (F.col("m") * (F.col("m") - F.col("largest"))).alias("pairs"))


def _merged(classes: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, class) after further links: the classes they join become one."""
    if classes is None:
        return cut_lineage(components(links).withColumnRenamed("component", "class"))
    of_u, of_v = (classes.select(F.col("node").alias(c), F.col("class").alias(f"class_{c}")) for c in "uv")
    edges = links.join(of_u, "u", "left").join(of_v, "v", "left")
    edges = edges.select(F.coalesce("class_u", "u").alias("u"), F.coalesce("class_v", "v").alias("v"))
    joined = components(edges).select(F.col("node").alias("class"), F.col("component").alias("larger"))
    moved = classes.join(joined, "class", "left").select("node", F.coalesce("larger", "class").alias("class"))
    fresh = joined.select(F.col("class").alias("node"), F.col("larger").alias("class")).join(classes, "node", "left_anti")
    return cut_lineage(moved.union(fresh))


def joined(
    docs: DataFrame, shingle: int = SHINGLE, star_rounds: int = STAR_ROUNDS, located: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, links, classes): doc_id, n, node of every document, and its
    locator if asked for; the checked links (u, v) that join the sets into
    classes; node, class of linked sets."""
    found = _candidates(docs, shingle, located)
    bodies = found.filter("node IS NOT NULL")
    sets = cut_lineage(bodies.select("node", "n", "singles", "subsets", "scans", "body").dropDuplicates(["node"]))
    costs = (
        sets.filter(F.col("n") <= LARGEST_LIGHT)
        .groupBy("n")
        .agg(F.sum("subsets").alias("subsets"), F.sum("scans").alias("scans"))
    )
    # At most LARGEST_LIGHT rows.
    light = boundary([tuple(r) for r in costs.collect()])
    lists = cut_lineage(_classed(_postings(sets, light), None).drop("class"))

    tried = classes = None
    rows = lists.withColumn("class", F.col("node"))
    for turn in range(star_rounds):
        checked = cut_lineage(_verified(_star_pairs(rows, turn), sets))
        tried = checked if tried is None else tried.union(checked)
        classes = _merged(classes, checked.filter("linked").select("u", "v"))
        rows = cut_lineage(_classed(lists, classes))
        if checked.filter("linked").count() * FEW_LINKS < checked.count():
            break
    long = cut_lineage(_work(rows).filter(F.col("pairs") > LONG_LIST * LONG_LIST).select("sig"))
    if not long.isEmpty():
        split = _split_lists(sets, rows.join(long, "sig", "left_semi").select("sig", "node", "n", "pos"))
        rows = cut_lineage(rows.join(long, "sig", "left_anti").unionByName(_classed(split, classes)))
    checked = cut_lineage(_verified(_cross_pairs(rows, tried), sets))
    classes = _merged(classes, checked.filter("linked").select("u", "v"))
    links = tried.union(checked).filter("linked").select("u", "v")
    return found.drop("singles", "subsets", "scans", "body"), links, classes


def _leasts(rows: DataFrame, classes: DataFrame, least: Column) -> DataFrame:
    """(node, least): the least of its class for every set."""
    by_set = rows.filter("node IS NOT NULL").groupBy("node").agg(least.alias("least"))
    by_set = by_set.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    by_class = by_set.groupBy("class").agg(F.min("least").alias("of_class"))
    return by_set.join(by_class, "class").select("node", F.col("of_class").alias("least"))


@finished
def near_copies(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    doc_id that links lead to, its own included)."""
    rows, _, classes = joined(docs, shingle)
    labels = _leasts(rows, classes, F.min("doc_id")).withColumnRenamed("least", "component_id")
    alone = rows.filter("node IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    found = rows.filter("node IS NOT NULL").join(labels, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return alone.union(found)


@finished
def _spare_rows(docs: DataFrame, shingle: int) -> DataFrame:
    """The locators of the rows that ``drop_near_copies`` drops."""
    rows, _, classes = joined(docs, shingle, located=True)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "locator", F.col("node").alias("of"))
    met = rows.filter("node IS NOT NULL").join(_leasts(rows, classes, F.min(place)), "node")
    repeats = F.coalesce((F.col("doc_id") == F.col("least.doc_id")) & (F.col("node") == F.col("least.of")), F.lit(False))
    return met.filter((F.col("locator") != F.col("least.locator")) & ~repeats).select(F.col("locator").alias("__locator"))


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each class: the row with the smallest id
    (null after all others), of equal ids the first by file and row.  Rows that
    repeat it, with its id and its set, stay along with it."""
    docs = exchange.from_files(docs, _locator())
    marked = docs.select(*(F.col(c) for c in docs.columns), _locator().alias("__locator"))
    return marked.join(_spare_rows(docs, shingle), "__locator", "left_anti").select(*docs.columns)


ORACLE_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
),
starts AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, CAST(len(words) > 0 AS INT) + 1))) AS i FROM split),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
  WHERE 100 * s.n >= 75 * (x.n + y.n - s.n)
),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.least AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS least FROM reached GROUP BY doc_id) r ON r.doc_id = d.doc_id
"""
