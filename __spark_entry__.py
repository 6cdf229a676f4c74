"""Registered queries: one per operator, each over its whole tables.

``queries()`` gives the Spark side and ``oracle_sql()`` the same results in
DuckDB SQL.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402
from docroute import fixtures  # noqa: E402
from docroute.functions.flags import new_flag_sql, strings_sql, with_sql  # noqa: E402
from docroute.functions.mimetypes import PREDICATES, is_audio, is_image, is_video  # noqa: E402
from docroute.operators import stages, updates  # noqa: E402
from docroute.operators.conditions import any_flag  # noqa: E402
from docroute.operators.engine import Engine, distinct_routes as drop_repeated_routes, select_sends  # noqa: E402
from docroute.operators.rules import Rule, default_rules  # noqa: E402
from docroute.plans.reports import routing_summary as summary  # noqa: E402
from docroute.plans.results import SupervisedLog  # noqa: E402
from docroute.plans.supervise import supervise as supervise_messages  # noqa: E402
from docroute.plans.supervise_log import supervise_log as supervise_whole_log  # noqa: E402
from docroute.schema import RESOLUTION_TYPE  # noqa: E402
from docroute.sources import messages as sm, sinks  # noqa: E402
from docroute.sources.documents import shared_folder, write_flags  # noqa: E402
from docroute.sources.rules import RulesTable  # noqa: E402
from docroute.streaming.supervise_stream import read_output, supervise_stream as start_stream  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    decoded = sm.decode_messages(fixtures.messages(spark, sf))
    return decoded.filter("reason is null").select("seq", "ts", "id", "reset")


def _supervised(spark: SparkSession, sf: str) -> SupervisedLog:
    return supervise_messages(
        fixtures.messages(spark, sf), fixtures.documents(spark, sf), Engine.default(analytical=True)
    )


def mimetype_predicates(spark, sf):
    return fixtures.documents(spark, sf).select(
        "id", "mimetype", *[test().alias(name) for name, test in PREDICATES.items()]
    )


def head_flags(spark, sf):
    return stages.head_flags(fixtures.documents(spark, sf), fixtures.FLAG_KEYS)


def stage_completed(spark, sf):
    return stages.stage_progress(fixtures.documents(spark, sf), RulesTable.default())


def sendable_allowed(spark, sf):
    entries = stages.required_entries(fixtures.documents(spark, sf), RulesTable.default())
    return entries.select("id", "stage_key", "flag", "allowed")


def can_queue(spark, sf):
    """Per message and flag, by the flags that the document had at first."""
    rows = sm.lookup_documents(_valid(spark, sf), fixtures.documents(spark, sf).select("id", "doclib"))
    return stages.queueable_flags(rows, fixtures.FLAG_KEYS, "reset", "seq", "id")


def queued_flags(spark, sf):
    return stages.queued_flags(fixtures.documents(spark, sf), fixtures.FLAG_KEYS)


def stage_sendables(spark, sf):
    return stages.stage_sendables(fixtures.documents(spark, sf), RulesTable.default())


def _one_rule(name: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rule = [r for r in default_rules(analytical=True) if r.name == name]
        resolved = Engine(rule).resolve(fixtures.documents(spark, sf))
        return resolved.filter("resolution is not null").select(
            "id",
            "resolution.stage_key",
            F.size("resolution.sends").alias("n_sends"),
            "resolution.error",
        )

    return query


def never_routed_media(spark, sf):
    """What the three media rules recognise; they route none of it."""
    engine = Engine([rule for rule in default_rules() if rule.name in ("Image", "Audio", "Video")])
    media = F.when(is_image(), "image").when(is_audio(), "audio").when(is_video(), "video")
    resolved = engine.resolve(fixtures.documents(spark, sf)).filter("resolution IS NULL")
    return resolved.select("id", "mimetype", media.alias("media")).filter("media is not null")


def _resolved(spark: SparkSession, sf: str, engine: Engine) -> DataFrame:
    return engine.resolve(fixtures.documents(spark, sf)).select(
        "id",
        "resolution.rule",
        "resolution.stage_key",
        F.expr("CASE WHEN resolution IS NOT NULL THEN size(resolution.sends) END").alias("n_sends"),
        "resolution.error",
    )


def resolve(spark, sf):
    return _resolved(spark, sf, Engine.default())


def resolve_analytical(spark, sf):
    return _resolved(spark, sf, Engine.default(analytical=True))


def routing_summary(spark, sf):
    return summary(Engine.default(analytical=True).resolve(fixtures.documents(spark, sf)))


def _shared_routes() -> Engine:
    return Engine.default(analytical=True, table=RulesTable(oracle.SHARED_ROUTES))


def distinct_routes(spark, sf):
    engine = _shared_routes()
    entries = stages.matched_entries(engine.resolve(fixtures.documents(spark, sf)), engine.table)
    return stages.sends_of(entries.withColumn("sends", drop_repeated_routes("sends")))


def shared_route_sends(spark, sf):
    engine = _shared_routes()
    return stages.sends_of(select_sends(engine.resolve(fixtures.documents(spark, sf)), engine.table))


def selected_sends(spark, sf):
    resolved = Engine.default(analytical=True).resolve(fixtures.documents(spark, sf))
    return stages.sends_of(select_sends(resolved))


def decode_messages(spark, sf):
    decoded = sm.decode_messages(fixtures.messages(spark, sf))
    return decoded.selectExpr("seq", "id", "CASE WHEN reset IS NOT NULL THEN size(reset) END AS n_reset", "ok")


def messages_with_document(spark, sf):
    documents = fixtures.documents(spark, sf).select("id", "mimetype")
    return sm.lookup_documents(_valid(spark, sf), documents).select("seq", "id", "mimetype")


def missing_documents(spark, sf):
    return sm.missing_documents(_valid(spark, sf), fixtures.documents(spark, sf)).select("seq", "id")


def dead_letters(spark, sf):
    folder = _run_folder(spark, "dead-letters")
    _supervised(spark, sf).dead_letters.write.parquet(folder)
    return spark.read.parquet(folder).select("seq", "reason")


def latest_flag_per_key(spark, sf):
    flags = stages.flag_rows(updates.latest_flag_per_key(fixtures.documents(spark, sf)))
    return flags.drop("version")


def reset_flags(spark, sf):
    reset = updates.reset_flags(fixtures.documents(spark, sf), _valid(spark, sf))
    return stages.flag_rows(reset).select("id", "flag_key", "started", "reset")


def reset_changed(spark, sf):
    return updates.reset_changed(_valid(spark, sf), fixtures.documents(spark, sf)).select("seq", "id", "changed")


def queue_flags(spark, sf):
    own = fixtures.documents(spark, sf).select("id", F.col("doclib.key").alias("own"))
    flags = stages.flag_rows(_supervised(spark, sf).documents)
    return flags.join(own, "id").select(
        "id", "flag_key", "queued", F.expr("NOT array_contains(own, flag_key)").alias("added")
    )


def publish(spark, sf):
    folder = _run_folder(spark, "queues")
    sinks.publish(_supervised(spark, sf).results, folder)
    return sinks.read_published(spark, folder)


def _status(results: DataFrame) -> DataFrame:
    return results.select("seq", "id", "status", "stage_key", F.size("sends").alias("n_sent"))


def supervise(spark, sf):
    return _status(_supervised(spark, sf).results)


def supervise_log(spark, sf):
    log = supervise_whole_log(
        fixtures.messages(spark, sf), fixtures.documents(spark, sf), Engine.default(analytical=True)
    )
    return _status(log.results)


def _run_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/docroute-{name}-{uuid.uuid4().hex}"


def supervise_log_hot(spark, sf):
    """A log in which one document has a third of the messages, and one that does
    not exist a seventh."""
    log = supervise_whole_log(
        fixtures.hot_messages(spark, sf), fixtures.documents(spark, sf), Engine.default(analytical=True)
    )
    return _status(log.results)


def _halves(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The messages in two parts, in the order of arrival."""
    messages = fixtures.messages(spark, sf)
    middle = messages.agg(F.min("seq") + F.floor((F.max("seq") - F.min("seq")) / 2)).first()[0]
    return [messages.filter(F.col("seq") <= F.lit(middle)), messages.filter(F.col("seq") > F.lit(middle))]


def _arrive(messages: DataFrame, folder: str) -> None:
    messages.repartitionByRange(2, "seq").write.mode("append").parquet(f"{folder}/messages")


def _run_stream(spark: SparkSession, folder: str, store) -> None:
    stream = sm.read_messages(spark, f"{folder}/messages", stream=True, files_per_trigger=2)
    engine = Engine.default(analytical=True)
    start_stream(stream, store, engine, f"{folder}/out", f"{folder}/checkpoint", available_now=True).awaitTermination()


def supervise_stream(spark, sf):
    folder = _run_folder(spark, "stream")
    for half in _halves(spark, sf):
        _arrive(half, folder)
    _run_stream(spark, folder, lambda: fixtures.documents(spark, sf))
    return _status(read_output(spark, f"{folder}/out", "results"))


def supervise_stream_live(spark, sf):
    """Between two batches every fifth document arrives, and a consumer begins and
    ends every second flag that waits in a queue."""
    folder = _run_folder(spark, "live")
    documents = fixtures.documents(spark, sf)
    first, second = _halves(spark, sf)
    documents.filter("doc_id % 5 <> 0").write.parquet(f"{folder}/store/1")
    _arrive(first, folder)
    _run_stream(spark, folder, lambda: spark.read.parquet(f"{folder}/store/1"))

    waits = f"f.started IS NULL AND array_contains({strings_sql(fixtures.FLAG_KEYS[::2])}, f.key)"
    at = "TIMESTAMP_NTZ '2031-01-01 00:00:00'"
    done = with_sql("f", started=at, ended=at)
    consumed = F.expr(f"transform(doclib, f -> CASE WHEN {waits} THEN {done} ELSE f END)")
    documents.withColumn("doclib", consumed).write.parquet(f"{folder}/store/2")
    _arrive(second, folder)
    _run_stream(spark, folder, lambda: spark.read.parquet(f"{folder}/store/2"))
    return _status(read_output(spark, f"{folder}/out", "results"))


def supervise_stream_requeue(spark, sf):
    """Three batches of every document's messages.  After the first, a consumer begins
    and ends every second flag that waits, among them those that the stream queued
    and the store does not know; the second resets some, which are sent again, and
    the third must hold what is queued for the second time."""
    folder = _run_folder(spark, "requeue")
    documents, messages = fixtures.documents(spark, sf), fixtures.interleaved_messages(spark, sf)
    documents.write.parquet(f"{folder}/store/1")
    thirds = [messages.filter(f"seq div 3000000000000 = {third}") for third in range(3)]
    _arrive(thirds[0], folder)
    _run_stream(spark, folder, lambda: spark.read.parquet(f"{folder}/store/1"))

    handled = strings_sql(fixtures.FLAG_KEYS[::2])
    at = "TIMESTAMP_NTZ '2030-01-01 02:30:00'"
    sent = read_output(spark, f"{folder}/out", "results").select("id", F.explode("sends.flag").alias("flag"))
    queued = sent.filter(f"array_contains({handled}, flag)").groupBy("id").agg(F.sort_array(F.collect_set("flag")).alias("sent"))
    done = with_sql("f", started=at, ended=at)
    own = f"transform(doclib, f -> CASE WHEN f.started IS NULL AND array_contains({handled}, f.key) THEN {done} ELSE f END)"
    new = f"transform(array_except(coalesce(sent, CAST(array() AS array<string>)), doclib.key), k -> {new_flag_sql('k')})"
    begun = f"transform({new}, f -> {with_sql('f', started=at, ended=at, queued='CAST(NULL AS BOOLEAN)')})"
    consumed = documents.join(queued.hint("merge"), "id", "left").withColumn("doclib", F.expr(f"concat({own}, {begun})")).drop("sent")
    consumed.write.parquet(f"{folder}/store/2")
    for third in thirds[1:]:
        _arrive(third, folder)
        _run_stream(spark, folder, lambda: spark.read.parquet(f"{folder}/store/2"))
    return _status(read_output(spark, f"{folder}/out", "results"))


def custom_rule(spark, sf):
    media = Rule("Media", is_image() | is_audio() | is_video(), ["media"])
    engine = Engine([*default_rules(), media], RulesTable(oracle.CUSTOM_ENTRIES))
    return _resolved(spark, sf, engine).drop("error")


def custom_engine(spark, sf):
    table = RulesTable(oracle.FLAG_TEST_ENTRIES)

    def send_to_all(documents: DataFrame) -> DataFrame:
        sends = ", ".join(
            f"named_struct('ordinal', {e.ordinal}, 'flag', '{e.flag}', 'route', '{e.route}')"
            for e in table.entries
        )
        resolution = (
            "named_struct('rule', 'FlagTest', 'stage_key', 'flag-test',"
            f" 'sends', array({sends}), 'error', NULL)"
        )
        return documents.withColumn("resolution", F.expr(resolution).cast(RESOLUTION_TYPE))

    supervised = supervise_messages(
        fixtures.messages(spark, sf), fixtures.documents(spark, sf), send_to_all, table
    )
    return _status(supervised.results)


def _custom_log(spark: SparkSession, sf: str, idle: Rule) -> DataFrame:
    engine = Engine([idle, *default_rules(analytical=True)], RulesTable(oracle.CUSTOM_ENTRIES))
    log = supervise_messages(fixtures.messages(spark, sf), fixtures.documents(spark, sf), engine)
    return _status(log.results)


def custom_rule_log(spark, sf):
    """A log with a rule that tests the flags: only documents none of whose flags is
    queued are sent to be captioned."""
    return _custom_log(spark, sf, Rule("Idle", F.lit(True), ["media"], when=~any_flag("queued")))


def custom_condition_log(spark, sf):
    """The same with a condition of its own on the flags, of which a log knows nothing."""
    idle = ~F.exists("doclib", lambda flag: F.coalesce(flag["queued"], F.lit(False)))
    return _custom_log(spark, sf, Rule("Idle", idle, ["media"]))


def rules_table(spark, sf):
    """Rules read from JSON lines, in which one stage requires nothing and one that
    no rule reaches is missing."""
    folder = _run_folder(spark, "rules")
    stages_of = [key for key in RulesTable.default().stages() if key != "analytical"]
    lines = [
        (key, [] if key == "ner" else [(e.flag, e.route, e.type) for e in RulesTable.default().stage(key)])
        for key in stages_of
    ]
    schema = "stage_key string, required array<struct<flag: string, route: string, type: string>>"
    spark.createDataFrame(lines, schema).write.json(folder)
    return _resolved(spark, sf, Engine.default(table=RulesTable.read(spark, folder)))


def written_flags(spark, sf):
    documents = fixtures.documents(spark, sf)
    snapshot = write_flags(documents, _supervised(spark, sf).documents, _run_folder(spark, "snapshot"))
    return snapshot.selectExpr(
        "id",
        "CAST(size(doclib) AS BIGINT) AS n_flags",
        "CAST(size(filter(doclib, f -> f.queued)) AS BIGINT) AS n_queued",
    )


def _text_operators():
    """The module of the text operators' queries, or None where it is not installed."""
    try:
        from docroute.llm import queries as module
    except ModuleNotFoundError as error:
        if error.name not in ("docroute.llm", "docroute.llm.queries", "corpus_pipeline"):
            raise
        return None
    return module


def _own_folder(spark: SparkSession) -> None:
    """A single-machine session that names no shared folder gets one of its own."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="docroute-"))


def _with_folder(query: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        _own_folder(spark)
        return query(spark, sf)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Documents per stage and queue at sf0.001."""
    return routing_summary(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {name: _with_folder(query) for name, query in _all_queries().items()}


def _all_queries() -> dict[str, Query]:
    rules = ["Archive", "Tabular", "HTML", "XML", "Text", "Document", "PDF", "Chemical", "Analytical"]
    return {
        "mimetype_predicates": mimetype_predicates,
        "head_flags": head_flags,
        "stage_completed": stage_completed,
        "sendable_allowed": sendable_allowed,
        "can_queue": can_queue,
        "queued_flags": queued_flags,
        "stage_sendables": stage_sendables,
        **{f"rule_{name.lower()}": _one_rule(name) for name in rules},
        "never_routed_media": never_routed_media,
        "resolve": resolve,
        "resolve_analytical": resolve_analytical,
        "routing_summary": routing_summary,
        "distinct_routes": distinct_routes,
        "shared_route_sends": shared_route_sends,
        "select_sends": selected_sends,
        "decode_messages": decode_messages,
        "messages_with_document": messages_with_document,
        "missing_documents": missing_documents,
        "dead_letters": dead_letters,
        "latest_flag_per_key": latest_flag_per_key,
        "reset_flags": reset_flags,
        "reset_changed": reset_changed,
        "queue_flags": queue_flags,
        "publish": publish,
        "supervise": supervise,
        "supervise_log": supervise_log,
        "supervise_log_hot": supervise_log_hot,
        "supervise_stream": supervise_stream,
        "supervise_stream_live": supervise_stream_live,
        "supervise_stream_requeue": supervise_stream_requeue,
        "custom_rule": custom_rule,
        "custom_engine": custom_engine,
        "custom_rule_log": custom_rule_log,
        "custom_condition_log": custom_condition_log,
        "rules_table": rules_table,
        "written_flags": written_flags,
        **(module.queries() if (module := _text_operators()) else {}),
    }


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB SQL."""
    return {**oracle.statements(), **(module.oracle_sql() if (module := _text_operators()) else {})}
