"""Exact deduplication by a stateful stream, in DataFrame operations only.

1. Every row is reduced to its digest (SHA-256 of the normalised text), its
   stable identifier (``doc_id``) and a locator of its content (file and row).
   That table is written to the shared folder.
2. A stream reads it in micro-batches.  Its state, on disk in RocksDB and never
   expired, holds for each digest the number of rows and the identifier and
   locator of the row that stays.  Changed states go out under the batch number,
   so a batch that is repeated after a failure replaces its own output.
3. Rows whose digest was hit more than once are fetched by their locator and
   compared, byte for byte, with the row that stays.  Should texts of one digest
   differ, the rows of that digest are grouped by the text itself.

A digest that holds a third of all rows costs nothing in the stream, which
aggregates before it shuffles.  In the joins that follow, rows of such a digest
are dealt over ``SALTS`` keys by their locator, and what they meet is there once
per salt.  At most ``HOT_DIGESTS`` digests can be that frequent.

Only rows that may have been hit are shuffled with their text.  They are picked
by a bitmap of 2**23 positions (1 MB whatever the input): a position that a
digest of one row shares with a hit one lets that row through to the join, where
it finds no partner, so a full bitmap costs time and no rows.

Null text counts as empty, and empty texts are equal.  Of equal texts the row
with the largest ``doc_id`` stays, null being smaller than any; among rows with
that id, the one with the last locator, but every row with the same id and text
reports ``kept`` as the id says.  An empty table gives no rows.  Columns of any
name pass through ``drop_copies`` as they are; ``exact_dedup`` reads the id and the
text only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.llm.tables import cut_lineage, finished, new_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Files of digests in a micro-batch.
FILES_PER_TRIGGER = 64
#: Digests of more rows than this, and than one in ``HOT_DIGESTS`` of all, are dealt
#: over ``SALTS`` keys.
HOT_ROWS, HOT_DIGESTS, SALTS = 500, 1000, 64
#: 2**15 positions in each of 2**8 bitmaps.
BITS, BITMAPS = 15, 8

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A partition's store is closed between batches, so memory does not grow with their number.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Files have the checksums of their file system; Spark's own are a second file for each.
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else megabytes of empty log a partition
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
}


def normalised() -> Column:
    """The text with A-Z in lower case; null is empty."""
    return F.translate(F.coalesce(F.col("own.text"), F.lit("")), UPPER, LOWER)


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _located(docs: DataFrame) -> DataFrame:
    """The rows as ``own``, whatever their columns are called, with the ``locator`` of
    the place they are read from."""
    here = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))

    def read(rows: DataFrame) -> DataFrame:
        return rows.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), here.alias("locator"))

    try:
        return read(docs)
    except AnalysisException:
        return read(cut_lineage(docs))


def digest_rows(located: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    return located.select(
        F.col("own.doc_id").cast("long").alias("doc_id"),
        "locator",
        sha256(normalised()).alias("text_sha256"),
        digest(normalised()).alias("digest"),
    )


def stream_groups(spark: SparkSession, path: str, folder: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Run the stream over the digest rows at ``path`` and give its last state:
    digest, n, keep (doc_id, locator)."""
    rows = (
        spark.readStream.schema(spark.read.parquet(path).schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )
    state = rows.groupBy("digest").agg(
        F.count("*").alias("n"), F.max(F.struct("doc_id", "locator")).alias("keep")
    )

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/state/batch={batch}")

    before = {key: spark.conf.get(key, None) for key in _STATE}
    try:
        for key, value in _STATE.items():
            spark.conf.set(key, value)
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    if not query.lastProgress:  # nothing to read
        return spark.createDataFrame([], state.schema)
    written = spark.read.schema(f"digest string, n long, keep {state.schema['keep'].dataType.simpleString()}")
    # Counts only grow, so the largest is the last state.
    last = written.parquet(f"{folder}/state").groupBy("digest").agg(F.max(F.struct("n", "keep")).alias("last"))
    return last.select("digest", "last.n", "last.keep")


def _position(digest: Column) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(1 << (BITS + BITMAPS)))


def _maybe_hit(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """``rows`` with ``maybe``: whether the digest may be among those of ``hits``."""
    at = _position(F.col("digest"))
    bitmaps = (
        hits.select(F.shiftright(at, BITS).alias("bitmap"), at.bitwiseAND((1 << BITS) - 1).alias("bit"))
        .groupBy("bitmap")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    bit = at.bitwiseAND((1 << BITS) - 1)
    byte = F.conv(F.hex(F.expr("substring(bits, CAST(bit DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    return (
        rows.withColumn("bitmap", F.shiftright(at, BITS))
        .withColumn("bit", bit)
        .join(F.broadcast(bitmaps), "bitmap", "left")
        .withColumn("maybe", F.coalesce(F.expr("0") < byte.bitwiseAND(F.expr("shiftleft(1, CAST(bit % 8 AS INT))")), F.lit(False)))
        .drop("bitmap", "bit", "bits")
    )


def _salted(groups: DataFrame, total: int) -> tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]:
    """Two functions that add a ``salt`` to tables with a digest: one deals the rows of
    a hot digest by their locator, the other repeats what they meet for each salt."""
    hot = groups.filter(F.col("n") > max(HOT_ROWS, total // HOT_DIGESTS)).select("digest", F.lit(True).alias("hot"))
    # Fewer than HOT_DIGESTS rows, for together they have at most all rows.
    hot = F.broadcast(cut_lineage(hot))

    def dealt(rows: DataFrame) -> DataFrame:
        salt = F.when(F.col("hot"), F.pmod(F.xxhash64("locator"), F.lit(SALTS)).cast("int")).otherwise(0)
        return rows.join(hot, "digest", "left").withColumn("salt", salt).drop("hot")

    def repeated(rows: DataFrame) -> DataFrame:
        salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        return rows.join(hot, "digest", "left").withColumn("salt", F.explode(salts)).drop("hot")

    return dealt, repeated


def _decisions(located: DataFrame, digest: Callable[[Column], Column], files_per_trigger: int) -> tuple[DataFrame, DataFrame]:
    """(decisions with locator and digest, groups of more than one row)."""
    spark = located.sparkSession
    folder = new_folder(spark, "dedup")
    digest_rows(located, digest).write.parquet(f"{folder}/digests")
    rows = spark.read.parquet(f"{folder}/digests")
    groups = cut_lineage(stream_groups(spark, f"{folder}/digests", folder, files_per_trigger).filter("n > 1"))
    dealt, repeated = _salted(groups, rows.count())
    keys = ["digest", "salt"]

    # Full bytes of the hits against those of the row that stays.
    texts = located.select("locator", digest(normalised()).alias("digest"), normalised().alias("body"), F.col("own.doc_id").cast("long").alias("doc_id"))
    maybe = _maybe_hit(texts, groups).filter("maybe").drop("maybe")
    # Written, since both sides of the comparison come from it.
    hit = cut_lineage(dealt(maybe).join(repeated(groups), keys))
    kept = hit.filter(F.col("locator") == F.col("keep.locator")).select("digest", F.col("body").alias("kept_body"))
    differ = (
        hit.select(*keys, "body").join(repeated(kept), keys).filter(F.col("body") != F.col("kept_body")).select("digest").distinct()
    )
    differ = cut_lineage(differ)
    state = groups.select("digest", "n", F.col("keep.doc_id").alias("keep_id"), F.col("keep.locator").alias("keep_locator"))
    joined = dealt(rows).join(repeated(state), keys, "left")
    if not differ.isEmpty():
        whole = hit.join(differ, "digest", "left_semi").groupBy("digest", "body").agg(
            F.count("*").alias("n"), F.max(F.struct("doc_id", "locator")).alias("keep")
        )
        exact = (
            hit.join(differ, "digest", "left_semi")
            .select("digest", "body", "locator")
            .join(whole, ["digest", "body"])
            .select("locator", F.col("n").alias("n2"), F.col("keep").alias("keep2"))
        )
        joined = (
            joined.join(exact, "locator", "left")
            .withColumn("keep_id", F.when(F.col("n2").isNull(), F.col("keep_id")).otherwise(F.col("keep2.doc_id")))
            .withColumn("keep_locator", F.when(F.col("n2").isNull(), F.col("keep_locator")).otherwise(F.col("keep2.locator")))
            .withColumn("n", F.coalesce("n2", "n"))
        )
    alone = F.col("n").isNull()
    decided = joined.select(
        "doc_id",
        "locator",
        "digest",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.when(alone, F.col("locator")).otherwise(F.col("keep_locator")).alias("keep_locator"),
        "text_sha256",
    )
    return decided, groups


@finished
def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    decided, _ = _decisions(_located(docs), digest, files_per_trigger)
    return decided.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


@finished
def _spare_rows(located: DataFrame, digest: Callable[[Column], Column], files_per_trigger: int) -> DataFrame:
    """The locators of the rows that ``drop_copies`` drops."""
    decided, _ = _decisions(located, digest, files_per_trigger)
    return decided.filter(F.col("locator") != F.col("keep_locator")).select("locator", "digest")


def drop_copies(docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """The rows of ``docs`` without all but one of each group of equal texts."""
    located = _located(docs)
    dropped = _spare_rows(located, digest, files_per_trigger)
    marked = _maybe_hit(located.withColumn("digest", digest(normalised())), dropped)
    hit = marked.filter("maybe").join(dropped.select("locator"), "locator", "left_anti").select(*marked.columns)
    return marked.filter("NOT maybe").union(hit).select("own.*")


ORACLE_SQL = """
WITH rows AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM rows WINDOW same AS (PARTITION BY body)
"""
