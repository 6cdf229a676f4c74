"""Whole logs with any resolver, which is asked where flags change.

A resolver is any function that adds a ``resolution`` column to documents, or an
engine whose conditions look at the flags.  What it makes of a message is known
only by giving it the document as it is at that message: the document's own
flags, stamped with the resets up to now, and queued or added by the first sends
before now.

Between two changes of its flags a document meets all messages alike, so the
resolver is asked once per interval.  Where resets lie is known from the log: it is
cut into intervals by the last reset, of each of which a table holds the first
message (the one that resets) and a few more, as many as there are flags that can
be sent for the first time within it.  First sends build on each other, so they are
found one after the other: a round asks for the intervals of its window, with the
first sends known so far, and takes the earliest message that sends a flag for the
first time.  There are no more rounds with a find than flags in the table.  Then
every interval, cut by the first sends within it, is asked about once more, and the
answers are joined to the messages.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docroute.functions import flags as ff
from docroute.functions.flags import quote, strings_sql
from docroute.functions.messages import MISSING_DOCUMENT
from docroute.operators.engine import NO_SENDS, select_sends
from docroute.operators.updates import last_resets, resets_per_document
from docroute.plans import supervise_log as plan
from docroute.plans.results import RESULT_COLUMNS, SupervisedLog, failed_results, status
from docroute.sources.documents import Work
from docroute.sources.rules import RulesTable

Resolver = Callable[[DataFrame], DataFrame]

# Messages per piece of a log.
PIECE_MESSAGES = 1_000_000
# Logs up to this long are looked at as a whole in every round.
SHORT_LOG = 64
# Bytes per piece that a broadcast is reckoned by.
PIECE_BYTES = 100
# Keys of flags that logs may reset, by default: each is a column of the running resets.
MAX_KEYS = 1_000

# The place before all messages.
BEFORE = "-9223372036854775807L"


def _reset_keys(valid: DataFrame, named: DataFrame, flags: list[str], most: int) -> list[str]:
    """The flags of the table, and the other keys that a reset list names and a
    document has: their number is checked."""
    asked = valid.select(F.explode("reset").alias("key")).distinct()
    own = named.select(F.explode("doclib.key").alias("key")).distinct()
    more = [r.key for r in asked.join(own, "key").limit(most + 1).collect()]
    if len(more) > most:
        raise ValueError(f"the log resets more than {most} different flags")
    return flags + sorted(set(more) - set(flags))


def running_resets(
    rows: DataFrame, flags: Sequence[str], pieces: int, work: Work, side: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> tuple[DataFrame, DataFrame]:
    """Cut whole logs by range of seq into pieces of bounded size, and give every
    message the last reset of each flag up to now.

    Gives (log, totals): the log (id, piece, seq, ts, asked, resets) as a table
    partitioned by piece, so that a reader of few pieces reads few files; totals
    has a row per document and piece, of which a document has few.
    """
    # Written first, since the ranges are sampled from it.
    rows = work.table(rows)
    ranged = work.table(
        rows.repartitionByRange(pieces, "id", "seq").withColumn("piece", F.spark_partition_id())
    )
    # Within the piece by a window, before it by a window over the totals.
    inside = Window.partitionBy("id", "piece").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    stamp = "named_struct('seq', seq, 'ts', ts, 'second', " + ff.epoch_second_sql("ts") + ")"
    resets = [
        F.max(F.expr(f"CASE WHEN array_contains(reset, {quote(flag)}) THEN {stamp} END")).over(inside)
        for flag in flags
    ]
    running = ranged.select(
        "id",
        "piece",
        "seq",
        "ts",
        F.array_intersect("reset", F.expr(strings_sql(flags))).alias("asked"),
        F.array(*resets).cast(f"array<{plan.RESET}>").alias("resets"),
    )
    places = range(len(flags))
    totals = (
        ranged.select(
            "id",
            "piece",
            "seq",
            "ts",
            *[
                F.expr(f"CASE WHEN array_contains(reset, {quote(flag)}) THEN seq END").alias(f"seq_{i}")
                for i, flag in enumerate(flags)
            ],
        )
        .groupBy("id", "piece")
        .agg(
            F.min("seq").alias("low"),
            F.max("seq").alias("high"),
            F.count("*").alias("n"),
            *[F.max(f"seq_{i}").alias(f"seq_{i}") for i in places],
            *[F.max_by("ts", f"seq_{i}").alias(f"ts_{i}") for i in places],
        )
    )
    last = [
        f"CASE WHEN seq_{i} IS NOT NULL THEN named_struct('seq', seq_{i}, 'ts', ts_{i},"
        f" 'second', {ff.epoch_second_sql(f'ts_{i}')}) END"
        for i in places
    ]
    totals = work.table(totals)
    carried = totals.select(
        "id",
        "piece",
        F.array(*[F.max(F.expr(c)).over(before) for c in last]).cast(f"array<{plan.RESET}>").alias("carried"),
    )
    log = work.table(
        running.join(side(carried), ["id", "piece"]).select(
            "id",
            "piece",
            "seq",
            "ts",
            "asked",
            F.zip_with("resets", "carried", lambda here, earlier: F.coalesce(here, earlier)).alias("resets"),
        ),
        "piece",
    )
    return log, totals.select("id", "piece", "low", "high", "n")


def unsent(totals: DataFrame, n_flags: int) -> DataFrame:
    """The state that the rounds begin with: nothing sent, nothing settled."""
    bounds = totals.groupBy("id").agg(F.min("low").alias("first"), F.max("high").alias("last"), F.sum("n").alias("n"))
    return bounds.select(
        "id",
        "last",
        F.array_repeat(F.lit(None).cast("bigint"), n_flags).alias("since"),
        F.expr("first - 1").alias("settled"),
        # Short logs are looked at as a whole.
        F.expr(f"IF(n <= {SHORT_LOG}, last - first, (last - first) div 64) + 1").alias("width"),
    )


def first_sends(evaluated: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Per document, the first message that sends a flag not sent before."""
    unsent = (
        f"transform(since, (first, i) -> CASE WHEN first IS NULL THEN get({strings_sql(flags)}, i) END)"
    )
    return (
        evaluated.select("id", "seq", F.expr(f"array_intersect(outcome.sends.flag, {unsent})").alias("sent_flags"))
        .filter(F.size("sent_flags") > 0)
        .groupBy("id")
        .agg(F.min("seq").alias("first_seq"), F.min_by("sent_flags", "seq").alias("sent_flags"))
    )


def advance(sent: DataFrame, step: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Enter the first sends found; documents without one have settled the window."""
    since = (
        "transform(since, (first, i) -> coalesce(first,"
        f" CASE WHEN array_contains(sent_flags, get({strings_sql(flags)}, i)) THEN first_seq END))"
    )
    return sent.join(step, "id", "left").select(
        "id",
        "last",
        F.expr(since).alias("since"),
        F.expr("coalesce(first_seq, least(last, settled + least(width, last - settled)))").alias("settled"),
        F.expr("CASE WHEN first_seq IS NULL AND width < last - settled THEN width * 8 ELSE width END")
        .alias("width"),
    )


def _intervals(log: DataFrame, n_flags: int) -> DataFrame:
    """Per document, piece and last reset: the messages up to which first sends can
    come (``seqs``: the first one, and one more than there are flags), and what the
    first one asks for.  A piece has a bounded number of messages."""
    order = Window.partitionBy("id", "piece", "last_reset").orderBy("seq")
    first = log.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= n_flags + 2)
    return first.groupBy("id", "piece", "last_reset").agg(
        F.sort_array(F.collect_list("seq")).alias("seqs"),
        F.min_by("asked", "seq").alias("asked"),
        F.min_by("resets", "seq").alias("resets"),
    )


def supervise_rounds(
    decoded: DataFrame,
    documents: DataFrame,
    resolver: Resolver,
    table: RulesTable,
    work: Work,
    piece_messages: int = PIECE_MESSAGES,
    most_keys: int = MAX_KEYS,
) -> SupervisedLog:
    """Handle every decoded message in the order of ``seq``."""
    valid = decoded.filter("reason is null").select("seq", "ts", "id", "reset")
    failed = failed_results(decoded.filter("reason is not null"))
    ids = valid.groupBy("id").agg(F.count("*").alias("n"))
    n_ids, n_messages = ids.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    def side(rows: DataFrame) -> DataFrame:
        """One side of a join, of which documents have rows.  If they are many it is
        sorted: Spark would go by the size of compressed files, and broadcast them."""
        return rows if n_ids * plan.DOCUMENT_BYTES <= plan.BROADCAST_BYTES else rows.hint("merge")

    known = documents.withColumn("doclib", F.expr(f"coalesce(doclib, {ff.NO_FLAGS})"))
    named = work.table(known.join(side(ids.select("id")), "id", "left_semi"))
    rows = work.table(plan.restrict(valid, named, n_ids, "left_semi"))
    missing = plan.restrict(valid, named, n_ids, "left_anti").select(
        "seq", "ts", "id", F.lit(MISSING_DOCUMENT).alias("reason")
    )

    flags = list(dict.fromkeys(e.flag for e in table.entries))
    keys = _reset_keys(valid, named, flags, most_keys)
    pieces = max(n_messages // piece_messages + 1, valid.sparkSession.sparkContext.defaultParallelism)
    log, totals = running_resets(rows, keys, pieces, work, side)
    log = log.withColumn("last_reset", F.expr(f"coalesce(array_max(transform(resets, r -> r.seq)), {BEFORE})"))
    intervals = work.table(_intervals(log, len(flags)))
    given = [c for c in documents.columns if c != "doclib"]
    document = F.struct(*[F.col(f"`{c}`") for c in given])
    heads = named.select("id", "doclib", document.alias("__document"))

    stamps = (
        f"filter(zip_with({strings_sql(keys)}, resets, (k, r) ->"
        " CASE WHEN r IS NOT NULL THEN named_struct('key', k, 'seq', r.seq, 'ts', r.ts) END), r -> r IS NOT NULL)"
    )
    carried = ["id", "piece", "last_reset", "before", "head", "next", "known"]

    def answers(asked: DataFrame) -> DataFrame:
        """What the resolver says of documents as they are in an interval: ``since``
        holds the first sends before it, ``head`` is the message that resets, if the
        interval has it, and ``next`` the first of the others."""
        now = asked.join(side(heads), "id").withColumn("resets", F.expr(stamps))
        now = now.select(
            *[F.col(f"__document.`{c}`").alias(c) for c in given],
            F.expr(plan.new_flags(flags)).alias("doclib"),
            F.struct(*carried).alias("__interval"),
            F.col("asked").alias("__asked"),
        )
        resolved = select_sends(resolver(now), table, "__asked", "__head_sends")
        selected = select_sends(resolved, table, None, "__sends")
        failed = F.col("resolution.error").isNotNull()
        return selected.select(
            *[F.col(f"__interval.{c}").alias(c) for c in carried],
            F.col("resolution.rule").alias("rule"),
            F.col("resolution.stage_key").alias("stage_key"),
            F.col("resolution.error").alias("error"),
            F.when(failed, F.expr(NO_SENDS)).otherwise(F.col("__head_sends")).alias("head_sends"),
            F.when(failed, F.expr(NO_SENDS)).otherwise(F.col("__sends")).alias("sends"),
        )

    def candidates(sent: DataFrame) -> DataFrame:
        """Of each interval that meets the window, the first messages not settled."""
        open_ = "filter(seqs, s -> s > settled AND s - settled <= width)"
        met = intervals.join(side(sent), "id").withColumn("open", F.expr(open_)).filter("size(open) > 0")
        resets_it = "CASE WHEN open[0] = last_reset THEN last_reset END"
        return met.selectExpr(
            "id", "piece", "last_reset", "open[0] AS before", f"{resets_it} AS head",
            "get(open, IF(open[0] = last_reset, 1, 0)) AS next", "since AS known", "asked", "resets", "since",
        )

    def found(sent: DataFrame) -> DataFrame:
        both = F.array(
            F.struct(F.col("head").alias("seq"), F.struct(F.col("head_sends").alias("sends")).alias("outcome")),
            F.struct(F.col("next").alias("seq"), F.struct("sends").alias("outcome")),
        )
        each = answers(candidates(sent)).select("id", F.col("known").alias("since"), F.explode(both).alias("one"))
        return first_sends(each.select("id", "since", "one.*").filter("seq IS NOT NULL"), flags)

    sent = work.table(unsent(totals, len(flags)))
    while not sent.filter("settled < last").isEmpty():
        sent = work.table(advance(sent, side(found(sent.filter("settled < last"))), flags))

    # Every interval once more, cut where a first send within it changes the flags.
    earlier = f"coalesce(array_max(filter(since, first -> first < {{}})), {BEFORE})"
    cut = intervals.join(side(sent.select("id", "since")), "id").withColumn(
        "before", F.explode(F.expr(f"array_distinct(transform(seqs, s -> {earlier.format('s')}))"))
    )
    final = cut.selectExpr(
        "id", "piece", "last_reset", "before", "CAST(NULL AS BIGINT) AS head", "CAST(NULL AS BIGINT) AS next",
        "since AS known", "asked", "resets", "transform(since, first -> CASE WHEN first <= before THEN first END) AS since",
    )
    told = work.table(answers(final).drop("head", "next", "known"))

    few = totals.count() * (PIECE_BYTES + 16 * len(flags)) <= plan.BROADCAST_BYTES
    own = totals.select("id", "piece").join(side(sent.select("id", "since")), "id")
    met = log.join(F.broadcast(own) if few else side(own), ["id", "piece"])
    met = met.select("id", "piece", "seq", "ts", "last_reset", F.expr(earlier.format("seq")).alias("before"))
    results = (
        met.join(side(told), ["id", "piece", "last_reset", "before"])
        .withColumn("sends", F.expr("CASE WHEN seq = last_reset THEN head_sends ELSE sends END"))
        .withColumnRenamed("error", "reason")
        .withColumn("status", status(F.col("reason"), F.col("stage_key"), F.col("sends")))
        .select(*RESULT_COLUMNS)
    )
    resets = resets_per_document(work.table(last_resets(rows)), named, flags)
    after = plan.documents_after(named, sent, resets, flags)
    return SupervisedLog(results.unionByName(failed_results(missing)).unionByName(failed), after, work)
