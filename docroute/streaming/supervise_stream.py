"""Continuous supervision: the log plan over micro-batches, on a live store.

The store belongs to others as well: documents arrive in it and consumers write
``started`` and ``ended`` into it between batches.  So every batch reads the store
anew, and the stream keeps only what it changed itself, flag by flag: the last
reset and the mark as queued.  These are laid over the document as the store has
it now.

A batch looks up the documents that its messages name, in the store and among the
changes, both sorted by the id.  It writes the changes it made under its own number,
so a batch that is repeated after a failure replaces its own output.  Now and then all
changes that the store does not hold by then are written anew as a base, and what
only older bases are made of is removed; a batch starts from the newest base that
is complete, whatever interval wrote it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docroute.functions import flags as ff
from docroute.functions.flags import let_sql
from docroute.plans.supervise import Resolver, handle_decoded
from docroute.plans.supervise_log import DECODED_COLUMNS
from docroute.sources.documents import Work, exists, few_ids, folders, id_in, read_documents, read_named, remove
from docroute.sources.messages import deal_out, decode_messages
from docroute.sources.rules import RulesTable
from docroute.sources.sinks import dead_letters, publish

# Every so many batches the changes of all batches are written anew.
COMPACT_EVERY = 20
# Changes in a file, about.
FILE_CHANGES = 1_000_000

#: A change to one flag: the last reset, when it was last marked as queued, and the
#: message that marked it first (the order of the flags that a document lacked).
CHANGE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("reset", T.TimestampNTZType()),
        T.StructField("queued_at", T.TimestampNTZType()),
        T.StructField("queued_by", T.LongType()),
    ]
)

#: The store: a folder of documents, or a function that reads them.
Store = str | Callable[[], DataFrame]


def _folder(path: str, output: str, batch_id: int) -> str:
    return f"{path}/{output}/batch_id={batch_id}"


def read_output(spark: SparkSession, path: str, output: str) -> DataFrame:
    """One of the outputs ``results``, ``dead_letters`` or ``sends``."""
    if output == "sends":
        return spark.read.text(f"{path}/sends").withColumnRenamed("value", "body")
    return spark.read.parquet(f"{path}/{output}")


def _base(spark: SparkSession, path: str, before: int) -> int:
    """The newest batch up to which all changes are in a complete base; -1 if none."""
    found = [int(name.split("=")[1]) for name in folders(spark, f"{path}/base")]
    complete = [b for b in found if b < before and exists(spark, f"{path}/base/upto={b}/_SUCCESS")]
    return max(complete, default=-1)


def changes(spark: SparkSession, path: str, before: int, ids: list[str] | None = None) -> DataFrame:
    """The last change (``CHANGE``) to every flag that a batch before this one
    changed, of the documents with the given ids."""
    base = _base(spark, path, before)
    parts = [f"{path}/base/upto={base}"] if base >= 0 else []
    parts += [p for b in range(base + 1, before) if exists(spark, p := _folder(path, "changes", b))]
    if not parts:
        return spark.createDataFrame([], CHANGE)
    # At most as many folders as lie between two bases.
    rows = spark.read.schema(CHANGE).parquet(*parts)
    if ids is not None:
        rows = rows.filter(id_in(ids))
    return rows.groupBy("id", "key").agg(
        F.max("reset").alias("reset"), F.max("queued_at").alias("queued_at"), F.min("queued_by").alias("queued_by")
    )


def lay_over(documents: DataFrame, changed: DataFrame, many: bool = False) -> DataFrame:
    """The documents with the stream's changes over their own flags.

    A reset counts if it is later than the flag's own, and collapses its
    duplicates.  A mark as queued counts unless the flag has been started since its
    last one: then what the store says is later.  A flag that the store lacks is added.
    ``many`` tells that the documents are too many to broadcast their changes.
    """
    gathered = changed.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("queued_by", "key", "reset", "queued_at"))).alias("__changes")
    )
    own = "get(filter(__changes, c -> c.key = f.key), 0)"
    stamp = (
        "CASE WHEN c.reset IS NOT NULL AND (f.reset IS NULL OR c.reset > f.reset) THEN c.reset ELSE f.reset END"
    )
    queued = "CASE WHEN c.queued_at IS NULL OR f.started > c.queued_at THEN f.queued ELSE true END"
    laid = f"transform(kept, f -> {let_sql(own, 'c', ff.with_sql('f', reset=stamp, queued=queued))})"
    renewed = "transform(filter(__changes, c -> c.reset IS NOT NULL), c -> c.key)"
    collapsed = f"concat(filter(doclib, f -> NOT array_contains(renewed, f.key)), {ff.latest_flags_sql('filter(doclib, f -> array_contains(renewed, f.key))')})"
    ordered = let_sql(renewed, "renewed", f"CASE WHEN size(renewed) = 0 THEN doclib ELSE {collapsed} END")
    missing = f"filter(__changes, c -> c.queued_by IS NOT NULL AND NOT {ff.contains_sql('doclib.key', 'c.key')})"
    added = f"transform({missing}, c -> {ff.new_flag_sql('c.key', 'c.reset')})"
    expression = f"CASE WHEN __changes IS NULL THEN doclib ELSE concat({let_sql(ordered, 'kept', laid)}, {added}) END"
    known = documents.withColumn("doclib", F.expr(f"coalesce(doclib, {ff.NO_FLAGS})"))
    joined = known.join(gathered.hint("merge") if many else gathered, "id", "left")
    return joined.withColumn("doclib", F.expr(expression)).select(*documents.columns)


def _read(store: Store, spark: SparkSession) -> DataFrame:
    return store() if callable(store) else read_documents(spark, store)


def current_documents(spark: SparkSession, store: Store, path: str, before: int) -> DataFrame:
    """The documents of the store with all changes of the batches before this one."""
    return lay_over(_read(store, spark), changes(spark, path, before), many=True)


def outstanding(changed: DataFrame, documents: DataFrame) -> DataFrame:
    """The changes that would still alter a document of the store: not those of a
    flag that it has once, reset as late and queued or started since."""
    flags = documents.join(changed.select("id").distinct(), "id", "left_semi").select("id", F.explode("doclib").alias("flag"))
    held = flags.groupBy("id", F.col("flag.key").alias("key")).agg(
        F.count("*").alias("n"),
        F.max("flag.started").alias("own_started"),
        F.max("flag.reset").alias("own_reset"),
        F.coalesce(F.bool_or("flag.queued"), F.lit(False)).alias("own_queued"),
    )
    settled = (
        "n = 1 AND (reset IS NULL OR coalesce(own_reset >= reset, false))"
        " AND (queued_at IS NULL OR own_queued OR coalesce(own_started > queued_at, false))"
    )
    joined = changed.join(held, ["id", "key"], "left")
    return joined.filter(f"n IS NULL OR NOT ({settled})").select(*CHANGE.fieldNames())


def _write_changes(rows: DataFrame, folder: str, files: int) -> None:
    """Files sorted by the id, each with a range of its own."""
    ranged = rows.coalesce(1) if files == 1 else rows.repartitionByRange(files, "id")
    ranged.sortWithinPartitions("id", "key").write.mode("overwrite").parquet(folder)


def _compact(spark: SparkSession, store: Store, path: str, batch_id: int) -> None:
    """Write a base up to this batch.  The one before it, and the changes since, stay
    for the case that this batch is repeated; what is older goes."""
    before = _base(spark, path, batch_id)
    work = Work(spark)
    left = work.table(outstanding(changes(spark, path, batch_id + 1), _read(store, spark)))
    _write_changes(left, f"{path}/base/upto={batch_id}", left.count() // FILE_CHANGES + 1)
    work.remove()
    for folder, most in (("base", before - 1), ("changes", before)):
        for name in folders(spark, f"{path}/{folder}"):
            if int(name.split("=")[1]) <= most:
                remove(spark, f"{path}/{folder}/{name}")


def _changed(log, decoded: DataFrame, named: DataFrame, many: bool = False) -> DataFrame:
    """The changes (``CHANGE``) that a batch made: resets of flags that the
    document had or got, and marks as queued.  ``many`` as in ``lay_over``."""

    def side(rows: DataFrame) -> DataFrame:
        return rows.hint("merge") if many else rows

    valid = decoded.filter("reason is null")
    marks = (
        log.results.select("id", "seq", "ts", F.explode("sends.flag").alias("key"))
        .groupBy("id", "key")
        .agg(F.min("seq").alias("queued_by"), F.max("ts").alias("queued_at"))
    )
    own = named.select("id", F.explode("doclib.key").alias("key")).distinct().withColumn("own", F.lit(True))
    resets = (
        valid.select("id", "seq", "ts", F.explode("reset").alias("key"))
        .join(side(own), ["id", "key"], "left")
        .join(side(marks.select("id", "key", "queued_by")), ["id", "key"], "left")
        # A flag that the document got in this batch can be reset from then on.
        .filter("own OR seq > queued_by")
        .groupBy("id", "key")
        .agg(F.max("ts").alias("reset"))
    )
    return resets.join(marks, ["id", "key"], "full_outer").select(*CHANGE.fieldNames())


def supervise_batch(
    batch: DataFrame,
    batch_id: int,
    store: Store,
    resolver: Resolver,
    path: str,
    compact_every: int = COMPACT_EVERY,
    table: RulesTable | None = None,
) -> None:
    """Handle one batch of messages and write all its outputs under its number."""
    spark = batch.sparkSession
    work = Work(spark)
    decoded = work.table(decode_messages(deal_out(batch)).select(*DECODED_COLUMNS))
    ids = work.table(decoded.filter("reason is null").select("id").distinct())
    few = few_ids(ids)
    if callable(store):
        named = store().filter(id_in(few)) if few is not None else store().join(ids.hint("merge"), "id", "left_semi")
    else:
        named = read_named(spark, store, ids, few)
    changed = changes(spark, path, batch_id, few)
    if few is None:
        # Sorted, as are all joins with a row or more for every document: Spark would
        # go by the size of compressed files, and broadcast them.
        changed = changed.join(ids.hint("merge"), "id", "left_semi")
    current = work.table(lay_over(named, changed, few is None))
    log = handle_decoded(decoded, current, resolver, work, table, keep=True)

    results_folder = _folder(path, "results", batch_id)
    log.results.write.mode("overwrite").parquet(results_folder)
    results = spark.read.schema(log.results.schema).parquet(results_folder)
    publish(results, _folder(path, "sends", batch_id))
    dead_letters(results).write.mode("overwrite").parquet(_folder(path, "dead_letters", batch_id))

    log.results = results
    made = work.table(_changed(log, decoded, current, few is None))
    _write_changes(made, _folder(path, "changes", batch_id), made.count() // FILE_CHANGES + 1)
    if (batch_id + 1) % compact_every == 0:
        _compact(spark, store, path, batch_id)
    work.remove()


def supervise_stream(
    messages: DataFrame,
    store: Store,
    resolver: Resolver,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    compact_every: int = COMPACT_EVERY,
    table: RulesTable | None = None,
) -> StreamingQuery:
    """Start handling a stream of messages; the outputs grow under ``path``.

    ``store`` names the folder of documents, or reads them; it is read anew in
    every batch.  All folders must be shared by the cluster.  With
    ``available_now`` the query ends when it has handled what there is.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        supervise_batch(batch, batch_id, store, resolver, path, compact_every, table)

    writer = messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


__all__ = ["current_documents", "read_output", "supervise_batch", "supervise_stream"]
