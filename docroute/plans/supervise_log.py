"""Handling a whole message log, in order, document by document.

Each message sees the flags that the messages before it left.  What a message
meets is a closed form of three things, per flag:

* the document's own entries, as they were at the start (``views``),
* the last message up to now that resets the flag (``resets``),
* the first message before now that sent the flag (``since``).

Resets are known from the log alone; only the first sends build on each other.
Documents with few messages are folded in one pass over their ordered messages.
The logs of documents with very many are cut into pieces, which are folded in
parallel, and again where the pieces before have sent what a fold did not know of.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docroute.functions import flags as ff
from docroute.functions.flags import let_sql, quote, strings_sql
from docroute.functions.messages import MISSING_DOCUMENT, RESET_WITHOUT_START
from docroute.operators.engine import NO_SENDS, SENDS, Engine
from docroute.operators.updates import last_resets, resets_per_document
from docroute.plans.results import RESULT_COLUMNS, SupervisedLog, failed_results, status
from docroute.sources.documents import Work
from docroute.sources.messages import decode_messages

# Documents with more messages than this are solved in pieces of as many.
HOT_MESSAGES = PIECE_MESSAGES = 2_000
# Messages per task of the fold.
FOLD_MESSAGES = 20_000
# Messages per task where logs are cut into pieces.
PART_MESSAGES = 1_000_000
# Up to this many document ids (24 characters each) are broadcast.
BROADCAST_IDS = 100_000
# Of more ids, those with more than a task's messages are dealt over so many keys.
SALTS = 64
# Up to this many bytes of what the pieces of logs need are broadcast.
BROADCAST_BYTES = 64_000_000
# Bytes per flag and per document that this is reckoned by.
FLAG_BYTES, DOCUMENT_BYTES = 250, 4_000

DECODED_COLUMNS = ["seq", "ts", "id", "reset", "reason"]
PIECE = ["id", "part", "sub"]

RESET = "struct<seq: bigint, ts: timestamp_ntz, second: bigint>"
OUTCOME = f"struct<seq: bigint, ts: timestamp_ntz, step: int, failed: boolean, sends: {SENDS}>"
STATE = f"struct<resets: array<{RESET}>, since: array<bigint>, log: array<{OUTCOME}>>"


def supervise_log(
    messages: DataFrame,
    documents: DataFrame,
    engine: Engine,
    hot_messages: int = HOT_MESSAGES,
    piece_messages: int = PIECE_MESSAGES,
    keep: bool = False,
    work: Work | None = None,
) -> SupervisedLog:
    """Handle every message in the order of ``seq``, which must be unique.

    ``keep`` saves the fold, for callers that use several outputs.
    """
    work = work or Work(messages.sparkSession)
    decoded = work.table(decode_messages(messages).select(*DECODED_COLUMNS))
    return supervise_decoded(decoded, documents, engine, work, hot_messages, piece_messages, keep)


def supervise_decoded(
    decoded: DataFrame,
    documents: DataFrame,
    engine: Engine,
    work: Work,
    hot_messages: int = HOT_MESSAGES,
    piece_messages: int = PIECE_MESSAGES,
    keep: bool = False,
) -> SupervisedLog:
    """``supervise_log`` for decoded messages, which are read several times."""
    if engine.reads_flags(documents):
        raise ValueError("a rule's condition looks at the flags: use supervise(), which handles such rules in rounds")
    valid = decoded.filter("reason is null").select("seq", "ts", "id", "reset")
    failed = failed_results(decoded.filter("reason is not null"))
    prepared = _prepare(documents, engine)

    hot = work.table(valid.groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") > hot_messages))
    n_ids, n_messages = hot.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    cold = valid if n_ids == 0 else restrict(valid, hot, n_ids, "left_anti")
    folded = _fold(cold, prepared, engine)
    if keep:
        folded = work.table(folded)
    results, changed = _fold_results(folded, engine), _fold_documents(folded, engine)
    if n_ids > 0:
        rows = restrict(valid, hot, n_ids, "left_semi")
        solved = _solve(rows, hot, n_ids, n_messages, prepared, engine, piece_messages, work)
        results, changed = results.unionByName(solved.results), changed.unionByName(solved.documents)
    return SupervisedLog(results.unionByName(failed), changed, work)


# -- what a message meets -------------------------------------------------------


def _prepare(documents: DataFrame, engine: Engine) -> DataFrame:
    """Documents with their eligible steps; all else follows from the flags."""
    return documents.select(
        "id",
        F.expr(f"coalesce(doclib, {ff.NO_FLAGS})").alias("doclib"),
        engine.eligible().alias("eligible"),
    )


def _views(engine: Engine, keys: str) -> str:
    """Per flag, what the document's own entries say: at first, and once a reset
    has collapsed them to the latest."""
    allowed = ff.sendable_allowed_each_sql(keys, analytical_flag=engine.analytical_flag)
    any_started = " 'any_started', exists(own, f -> f.started IS NOT NULL)," if engine.tests_flags else ""
    view = (
        f"named_struct('always', key = {quote(engine.analytical_flag)}, 'present', size(own) > 0,"
        " 'allowed', size(own) > 0 AND allowed[i],"
        " 'any_ended', exists(own, f -> f.ended IS NOT NULL),"
        " 'any_queued', exists(own, f -> coalesce(f.queued, false)),"
        f"{any_started}"
        f" 'last_second', {ff.epoch_second_sql('last.started')},"
        " 'last_ended', last.ended IS NOT NULL,"
        " 'last_queued', coalesce(last.queued, false))"
    )
    last = let_sql(f"get({ff.latest_flags_sql('own')}, 0)", "last", view)
    own = let_sql("filter(doclib, f -> f.key = key)", "own", last)
    return let_sql(allowed, "allowed", f"transform({keys}, (key, i) -> {own})")


def _standings(engine: Engine, resets: str, since: str, asked: str) -> str:
    """Per flag: is it allowed, has it ended, may this message queue it?  For tests
    also: is it there, queued, started?"""
    renewed = (
        "CASE WHEN view.present THEN reset IS NOT NULL ELSE coalesce(reset.seq > first, false) END"
    )
    queued = "first IS NOT NULL OR CASE WHEN renewed THEN view.last_queued ELSE view.any_queued END"
    standing = (
        "named_struct('allowed',"
        " CASE WHEN view.always OR (NOT view.present AND first IS NULL) THEN true"
        " WHEN renewed THEN reset.second > view.last_second ELSE view.allowed END,"
        " 'ended', CASE WHEN renewed THEN view.last_ended ELSE view.any_ended END,"
        f" 'can_queue', {ff.contains_sql(asked, f'get({engine.flags_sql}, i)')} OR NOT"
        f" ({queued})"
    )
    if engine.tests_flags:
        standing += (
            f", 'has', view.present OR first IS NOT NULL, 'queued', {queued},"
            " 'started', CASE WHEN renewed THEN view.last_second IS NOT NULL ELSE view.any_started END"
        )
    standing += ")"
    body = let_sql(
        f"get({resets}, i)",
        "reset",
        let_sql(f"get({since}, i)", "first", let_sql(renewed, "renewed", standing)),
    )
    return f"transform(views, (view, i) -> {body})"


def _outcome(engine: Engine, seq: str, ts: str, standings: str) -> str:
    """The step a message takes and what it sends."""
    step = engine.choose_sql(
        "passes" if engine.tests_flags else "eligible", "allowed", lambda entry: f"standings[{entry}.place].ended"
    )
    sends = engine.sends_sql(
        "step", "allowed", lambda entry: f"standings[{entry}.marked_place].can_queue"
    )
    outcome = (
        f"named_struct('seq', {seq}, 'ts', {ts}, 'step', step.n, 'failed', failed,"
        f" 'sends', CASE WHEN failed THEN {NO_SENDS} ELSE {sends} END)"
    )
    failed = let_sql(engine.failed_sql("step", "allowed"), "failed", outcome)
    chosen = let_sql("transform(standings, s -> s.allowed)", "allowed", let_sql(step, "step", failed))
    if engine.tests_flags:
        chosen = let_sql(engine.passes_sql("eligible", "standings"), "passes", chosen)
    return let_sql(standings, "standings", chosen)


def new_flags(flags: Sequence[str]) -> str:
    """The flags of a document after some of its log, from ``doclib``, ``resets`` and
    ``since`` (aligned to ``flags``): named ones stamped with their last reset, sent
    ones queued, sent ones it lacked added in the order of sending."""
    flags_sql = strings_sql(flags)

    def last(key: str, field: str) -> str:
        return f"get(resets.{field}, CAST(array_position(resets.key, {key}) AS INT) - 1)"

    sent = (
        f"filter(transform(since, (first, i) -> named_struct('first', first, 'i', i,"
        f" 'key', get({flags_sql}, i))), s -> s.first IS NOT NULL)"
    )
    own = (
        "CASE WHEN coalesce(arrays_overlap(doclib.key, resets.key), false)"
        f" THEN {ff.stamp_resets_sql('doclib', lambda key: last(key, 'ts'))} ELSE doclib END"
    )
    reset = f"CASE WHEN {last('s.key', 'seq')} > s.first THEN {last('s.key', 'ts')} END"
    added = (
        f"transform(array_sort(filter(sent, s -> NOT {ff.contains_sql('doclib.key', 's.key')})),"
        f" s -> {ff.new_flag_sql('s.key', reset)})"
    )
    marked = let_sql(own, "own_flags", ff.mark_queued_sql("transform(sent, s -> s.key)", "own_flags"))
    return let_sql(sent, "sent", f"concat({marked}, {added})")


def _results(outcomes: DataFrame, engine: Engine) -> DataFrame:
    """Result rows from (id, found, outcome)."""
    return (
        outcomes.select(
            F.col("outcome.seq").alias("seq"),
            F.col("outcome.ts").alias("ts"),
            "id",
            F.expr(engine.label_sql("outcome.step", "rule")).alias("rule"),
            F.expr(engine.label_sql("outcome.step", "stage_key")).alias("stage_key"),
            F.col("outcome.sends").alias("sends"),
            F.when(~F.col("found"), F.lit(MISSING_DOCUMENT))
            .when(F.col("outcome.failed"), F.lit(RESET_WITHOUT_START))
            .alias("reason"),
        )
        .withColumn("status", status(F.col("reason"), F.col("stage_key"), F.col("sends")))
        .select(*RESULT_COLUMNS)
    )


# -- documents with few messages: one fold ---------------------------------------


def _fold(valid: DataFrame, prepared: DataFrame, engine: Engine) -> DataFrame:
    """One row per document: its messages, outcomes and first sends.  The messages
    are grouped on the id, which the join with the documents reuses."""
    n_messages = valid.count()
    parts = _fold_parts(valid.sparkSession, n_messages)
    # Many documents are sorted: Spark would go by the size of compressed files, and
    # broadcast them.
    prepared = prepared if n_messages * DOCUMENT_BYTES <= BROADCAST_BYTES else prepared.hint("merge")
    logs = valid.repartition(parts, "id").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("seq", "ts", "reset"))).alias("messages"))
    joined = logs.join(prepared.withColumn("found", F.lit(True)), "id", "left")
    joined, keys, width = _followed(joined, engine)
    unhandled = (
        f"CAST(named_struct('resets', NULL, 'since', NULL, 'log', transform(messages, m -> named_struct("
        f"'seq', m.seq, 'ts', m.ts, 'step', NULL, 'failed', false, 'sends', array()))) AS {STATE})"
    )
    start = f"array_repeat(CAST(NULL AS {RESET}), {width})", f"array_repeat(CAST(NULL AS BIGINT), {width})"
    handled = _handled(engine, keys, *start)
    return (
        joined.withColumn("found", F.coalesce("found", F.lit(False)))
        .withColumn("state", F.expr(f"CASE WHEN found THEN {handled} ELSE {unhandled} END"))
        .select("id", "found", "messages", "doclib", "state")
    )


def _fold_parts(spark: SparkSession, n_messages: int) -> int:
    """The fold is bound by its work, not by its data, so there is a partition for
    so many messages, where adaptive execution would go by bytes."""
    return max(spark.sparkContext.defaultParallelism, n_messages // FOLD_MESSAGES + 1)


def _followed(documents: DataFrame, engine: Engine) -> tuple[DataFrame, str, str]:
    """Prepared documents with the views of the flags that are followed, the text of
    these flags, and that of their number."""
    keys, width = strings_sql(engine.watched), str(len(engine.watched))
    if engine.watches_all:
        documents = documents.withColumn("keys", F.expr(f"array_union({keys}, doclib.key)"))
        keys, width = "keys", "size(keys)"
    return documents.withColumn("views", F.expr(_views(engine, keys))), keys, width


def _handled(engine: Engine, keys: str, resets: str, since: str) -> str:
    """The state after the array ``messages``, from the last resets and the first
    sends before them (arrays, aligned to ``keys``)."""
    start = f"CAST(named_struct('resets', {resets}, 'since', {since}, 'log', array()) AS {STATE})"
    reset = f"named_struct('seq', m.seq, 'ts', m.ts, 'second', {ff.epoch_second_sql('m.ts')})"
    named = f"CASE WHEN array_contains(m.reset, get({keys}, i)) THEN stamp ELSE last END"
    resets_now = (
        "CASE WHEN size(m.reset) > 0 THEN "
        + let_sql(reset, "stamp", f"transform(state.resets, (last, i) -> {named})")
        + " ELSE state.resets END"
    )
    fresh = _outcome(
        engine, "m.seq", "m.ts", _standings(engine, "resets_now", "state.since", "m.reset")
    )
    # A message that resets nothing repeats the outcome of the one before it, if
    # that one sent nothing.
    outcome = (
        "CASE WHEN coalesce(size(before.sends) = 0, false) AND (m.reset IS NULL OR size(m.reset) = 0)"
        " THEN named_struct('seq', m.seq, 'ts', m.ts, 'step', before.step,"
        f" 'failed', before.failed, 'sends', before.sends) ELSE {fresh} END"
    )
    since_now = (
        "CASE WHEN size(outcome.sends) > 0 THEN transform(state.since, (first, i) ->"
        f" coalesce(first, CASE WHEN array_contains(outcome.sends.flag, get({keys}, i)) THEN m.seq END))"
        " ELSE state.since END"
    )
    # No cast here: it would copy the whole log at every message.
    advanced = (
        f"named_struct('resets', resets_now, 'since', {since_now}, 'log', concat(state.log, array(outcome)))"
    )
    handle = let_sql(
        "get(state.log, size(state.log) - 1)",
        "before",
        let_sql(resets_now, "resets_now", let_sql(outcome, "outcome", advanced)),
    )
    return f"aggregate(messages, {start}, (state, m) -> {handle})"


def _fold_results(folded: DataFrame, engine: Engine) -> DataFrame:
    # No log is empty; the outer form only keeps Spark from testing for it first,
    # which would run the fold twice.
    return _results(folded.select("id", "found", F.explode_outer("state.log").alias("outcome")), engine)


def _fold_documents(folded: DataFrame, engine: Engine) -> DataFrame:
    """The new flags of the folded documents."""
    latest = (
        "array_max(transform(filter(asking, m -> array_contains(m.reset, key)),"
        " m -> named_struct('seq', m.seq, 'ts', m.ts)))"
    )
    stamp = let_sql(latest, "m", "named_struct('key', key, 'seq', m.seq, 'ts', m.ts)")
    resets = f"transform(array_distinct(flatten(transform(asking, m -> m.reset))), key -> {stamp})"
    return (
        folded.filter("found")
        .select(
            "id",
            "doclib",
            F.col("state.since").alias("since"),
            F.expr("filter(messages, m -> size(m.reset) > 0)").alias("asking"),
        )
        .withColumn("resets", F.expr(resets))
        .select("id", F.expr(new_flags(engine.flags)).alias("doclib"))
    )


# -- documents with very many messages: pieces of their logs --------------------------


def restrict(valid: DataFrame, hot: DataFrame, n_ids: int, how: str) -> DataFrame:
    """Messages of the hot documents, or of the others.  The ids are broadcast if
    they are few; if not, both sides are sorted, and the documents with more than a
    task's messages, which are few, are salted on both, so that no id is one task.

    The hint stands since Spark would go by the compressed size of the ids' table,
    and broadcast millions of them."""
    ids = hot.select("id")
    if n_ids <= BROADCAST_IDS:
        return valid.join(F.broadcast(ids), "id", how)
    heavy = valid.groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") > PART_MESSAGES)
    heavy = F.broadcast(heavy.select("id", F.lit(True).alias("__heavy")))
    salt = F.when(F.col("__heavy"), F.pmod(F.xxhash64("seq"), F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.when(F.col("__heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = ids.join(heavy, "id", "left").select("id", F.explode(salts).alias("__salt")).hint("merge")
    dealt = valid.join(heavy, "id", "left").withColumn("__salt", salt).drop("__heavy")
    return dealt.join(salted, ["id", "__salt"], how).drop("__salt")


def _pieces(rows: DataFrame, n_messages: int, piece_messages: int, work: Work) -> DataFrame:
    """Whole logs in pieces of bounded length, in order of (part, sub): their messages.
    The log is cut by range of seq into parts, and these by number into pieces."""
    parts = max(n_messages // PART_MESSAGES + 1, rows.sparkSession.sparkContext.defaultParallelism)
    # Written first, since the ranges are sampled from it, and since a part is
    # known by its partition.
    rows = work.table(rows)
    ranged = work.table(rows.repartitionByRange(parts, "id", "seq").withColumn("part", F.spark_partition_id()))
    number = F.row_number().over(Window.partitionBy("id", "part").orderBy("seq")) - 1
    pieces = ranged.withColumn("sub", F.floor(number / piece_messages).cast("int"))
    return pieces.groupBy("id", "part", "sub").agg(F.sort_array(F.collect_list(F.struct("seq", "ts", "reset"))).alias("messages"))


def _before(values: DataFrame, merged: Callable[[Column], Column], kind: str) -> DataFrame:
    """Of arrays ``value`` per piece (id, part, sub), what ``merged`` makes of each
    place over all pieces before, as an array: a window per document and place."""
    before = Window.partitionBy("id", "i").orderBy("part", "sub").rowsBetween(Window.unboundedPreceding, -1)
    each = values.select("id", "part", "sub", F.posexplode("value").alias("i", "one"))
    met = each.withColumn("met", merged(F.col("one")).over(before))
    back = met.groupBy("id", "part", "sub").agg(F.sort_array(F.collect_list(F.struct("i", "met"))).alias("met"))
    return back.select("id", "part", "sub", F.expr(f"CAST(met.met AS array<{kind}>)").alias("value"))


def _solve(
    rows: DataFrame, hot: DataFrame, n_ids: int, n_messages: int, prepared: DataFrame, engine: Engine, piece_messages: int, work: Work
) -> SupervisedLog:
    """Solve whole logs without ever holding one: pieces are folded in parallel, each
    from the first sends before it as they are known by then.

    The first piece of a document begins with none.  The others begin with what the
    pieces before them have found, and are folded anew when that has changed.  A
    piece is right once those before it are, so after as many passes as there are
    pieces with a first send, and two more, nothing changes; first sends crowd at the
    beginning of a log, and their number within a piece does not matter.
    """
    found = prepared.join(hot.select("id"), "id", "left_semi")
    found, keys, width = _followed(found, engine)
    found = work.table(found)
    rows = work.table(rows)
    missing = restrict(rows, found, n_ids, "left_anti").select(
        "seq", "ts", "id", F.lit(MISSING_DOCUMENT).alias("reason")
    )
    pieces = _pieces(restrict(rows, found, n_ids, "left_semi"), n_messages, piece_messages, work)
    # What a piece needs besides its messages is a few kilobytes per document.
    small = n_ids * (DOCUMENT_BYTES + FLAG_BYTES * len(engine.watched)) <= BROADCAST_BYTES and not engine.watches_all
    met = work.table(pieces.join(F.broadcast(found) if small else found, "id"))
    stamp = f"named_struct('seq', m.seq, 'ts', m.ts, 'second', {ff.epoch_second_sql('m.ts')})"
    last = let_sql("get(asking, size(asking) - 1)", "m", f"CASE WHEN m IS NOT NULL THEN {stamp} END")
    last = let_sql("filter(messages, m -> array_contains(m.reset, key))", "asking", last)
    own_resets = met.select(*PIECE, F.expr(f"transform({keys}, key -> {last})").alias("value"))
    carried = _before(own_resets, F.max, RESET).withColumnRenamed("value", "carried")
    parts = _fold_parts(rows.sparkSession, n_messages)
    met = work.table(met.join(carried, PIECE).repartition(parts, *PIECE))

    def fold(begun: DataFrame) -> DataFrame:
        """Pieces, given as (id, part, sub, entry), folded."""
        joined = met.join(begun, PIECE).repartition(parts, *PIECE)
        folded = joined.withColumn("state", F.expr(_handled(engine, keys, "carried", "entry")))
        own = "zip_with(entry, state.since, (old, now) -> CASE WHEN old IS NULL THEN now END)"
        return work.table(folded.select(*PIECE, "entry", F.expr(own).alias("value"), F.col("state.log").alias("log")))

    none = F.expr(f"array_repeat(CAST(NULL AS BIGINT), {width})")
    first = met.groupBy("id").agg(F.min(F.struct("part", "sub")).alias("at")).select("id", "at.*")
    folds = [fold(met.select(*PIECE, none.alias("entry")).join(first, PIECE, "left_semi"))]
    while True:
        done = reduce(DataFrame.union, [f.withColumn("pass", F.lit(i)) for i, f in enumerate(folds)])
        latest = done.join(done.groupBy(*PIECE).agg(F.max("pass").alias("pass")), [*PIECE, "pass"])
        known = met.select(*PIECE, none.alias("none")).join(latest.select(*PIECE, "entry", "value"), PIECE, "left")
        known = known.select(*PIECE, "entry", F.coalesce("value", "none").alias("value"))
        now = _before(known, F.min, "bigint").withColumnRenamed("value", "now")
        changed = known.join(now, PIECE).filter("NOT (entry <=> now)")
        stale = work.table(changed.select(*PIECE, F.col("now").alias("entry")))
        if stale.isEmpty():
            break
        folds.append(fold(stale))

    outcomes = latest.select("id", F.lit(True).alias("found"), F.explode_outer("log").alias("outcome"))
    since = latest.select("id", F.posexplode("value").alias("i", "first")).groupBy("id", "i").agg(F.min("first").alias("first"))
    since = since.groupBy("id").agg(F.expr("sort_array(collect_list(struct(i, first))).first").alias("since"))
    resets = resets_per_document(work.table(last_resets(rows)), found, engine.flags)
    documents = documents_after(found, since, resets, engine.flags)
    return SupervisedLog(_results(outcomes, engine).unionByName(failed_results(missing)), documents, work)


def documents_after(found: DataFrame, sent: DataFrame, resets: DataFrame, flags: Sequence[str]) -> DataFrame:
    """The new flags (id, doclib), given the last resets and first sends."""
    no_resets = "CAST(array() AS array<struct<key: string, seq: bigint, ts: timestamp_ntz>>)"
    return (
        found.join(sent.hint("merge"), "id")
        .join(resets.hint("merge"), "id", "left")
        .withColumn("resets", F.expr(f"coalesce(resets, {no_resets})"))
        .select("id", F.expr(new_flags(flags)).alias("doclib"))
    )


