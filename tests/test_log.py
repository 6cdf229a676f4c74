"""Whole logs: the fold, the parallel rounds and the stream against each other
and against the plain-Python model."""

import json

import pytest
from pyspark.sql import functions as F

from docroute import fixtures
from docroute.operators.engine import Engine
from docroute.plans import supervise_log as plan
from docroute.plans.supervise import supervise
from docroute.plans.supervise_log import supervise_log
from docroute.operators.rules import Rule, default_rules
from docroute.sources.documents import read_documents, write_flags
from docroute.sources.messages import read_messages
from docroute.streaming.supervise_stream import (
    current_documents,
    read_output,
    supervise_batch,
    supervise_stream,
)
from tests import model

SF = "/root/testdata/sf0.001"
FIELDS = ["key", "started", "ended", "reset", "queued"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    fixtures.documents(spark, SF).write.parquet(f"{folder}/documents")
    # Every third message goes to one document: a hot key.
    hot = F.regexp_replace("body", '"id":"[0-9a-f]{24}"', '"id":"%024x"' % 16)
    messages = fixtures.messages(spark, SF).withColumn(
        "body", F.when(F.col("seq") % 3 == 0, hot).otherwise(F.col("body"))
    )
    # A few more that find nothing or cannot be read, and a whole hot missing one.
    missing = F.lit('{"id":"%024x"}' % 999_999)
    messages = messages.withColumn("body", F.when(F.col("seq") % 7 == 1, missing).otherwise(F.col("body")))
    messages.coalesce(2).write.parquet(f"{folder}/messages")
    return spark.read.parquet(f"{folder}/documents"), spark.read.parquet(f"{folder}/messages")


@pytest.fixture(scope="module")
def expected(tables):
    documents, messages = tables
    state = {
        r.id: (r.mimetype, [{k: f[k] for k in FIELDS} for f in r.doclib]) for r in documents.collect()
    }
    results, touched = {}, set()
    for r in messages.orderBy("seq").collect():
        try:
            body = json.loads(r.body)
        except ValueError:
            results[r.seq] = ("undecodable", None, [])
            continue
        if "id" not in body:
            results[r.seq] = ("undecodable", None, [])
        elif body["id"] not in state:
            results[r.seq] = ("missing_document", None, [])
        else:
            touched.add(body["id"])
            results[r.seq] = model.handle(*state[body["id"]], body.get("reset"), r.ts)
    return results, {i: rows(state[i][1]) for i in touched}


def rows(flags):
    return sorted((tuple(f[k] for k in FIELDS) for f in flags), key=repr)


def outcome(results):
    return {r.seq: (r.status, r.stage_key, [s.route for s in r.sends]) for r in results.collect()}


def changed(documents):
    return {r.id: rows(r.doclib) for r in documents.collect()}


@pytest.mark.parametrize("hot_messages", [2_000, 50, 5, 0])
def test_log_equals_the_model(tables, expected, hot_messages):
    documents, messages = tables
    log = supervise_log(
        messages, documents, Engine.default(True), hot_messages=hot_messages, piece_messages=40
    )
    assert outcome(log.results) == expected[0]
    assert changed(log.documents) == expected[1]


def test_salted_split_equals_the_model(tables, expected, monkeypatch):
    monkeypatch.setattr(plan, "BROADCAST_IDS", 0)
    documents, messages = tables
    log = supervise_log(messages, documents, Engine.default(True), hot_messages=50)
    assert outcome(log.results) == expected[0]


def test_tests_of_flags_equal_conditions_on_them(spark, tables):
    """A test is followed through the log, a condition asked for at every change; cold
    and hot documents alike."""
    from docroute.operators.conditions import all_flags, any_flag, ended, has, queued, started
    from docroute.operators.rules import Stage

    documents, messages = tables
    flag = lambda test: lambda f: test(f)
    own = lambda key, test: F.exists("doclib", lambda f: (f["key"] == key) & test(f))
    is_queued, has_ended = (lambda f: F.coalesce(f["queued"], F.lit(False))), (lambda f: f["ended"].isNotNull())
    begun = lambda f: f["started"].isNotNull()
    cases = [
        (~any_flag("queued"), ~F.exists("doclib", flag(is_queued))),
        (has("rawtext") & ~ended("rawtext"), F.array_contains("doclib.key", "rawtext") & ~own("rawtext", has_ended)),
        (queued("bounding_box") | started("analytical"), own("bounding_box", is_queued) | own("analytical", begun)),
        (
            all_flags("ended") | queued("no.such.flag"),
            F.forall(F.col("doclib.key"), lambda k: F.exists("doclib", lambda f: (f["key"] == k) & has_ended(f))),
        ),
    ]
    for test, condition in cases:
        with_test = Engine([Rule("Own", F.lit(True), ["text"], when=test), *default_rules(True)])
        with_condition = Engine([Rule("Own", condition, ["text"]), *default_rules(True)])
        assert not with_test.reads_flags(documents) and with_condition.reads_flags(documents)
        want = supervise(messages, documents, with_condition)
        for hot in (2_000, 20):
            got = supervise_log(messages, documents, with_test, hot_messages=hot, piece_messages=15)
            assert outcome(got.results) == outcome(want.results)
            assert changed(got.documents) == changed(want.documents)
        resolved = [
            sorted((r.id, r.resolution) for r in e.resolve(documents).collect()) for e in (with_test, with_condition)
        ]
        assert repr(resolved[0]) == repr(resolved[1])
    staged = Engine([Rule("Own", F.lit(True), [Stage("text", when=has("rawtext"))], when=~ended("rawtext"))])
    joint = Engine([Rule("Own", cases[1][1], ["text"])])
    assert outcome(supervise(messages, documents, staged).results) == outcome(supervise(messages, documents, joint).results)


def test_passes_do_not_grow_with_the_flags(spark, tables, monkeypatch):
    """First sends at the beginning of a log are found in the same passes, twelve or a
    hundred of them."""
    import tests.helpers as h
    from docroute.sources.rules import RulesTable

    passes = []
    for n in (12, 100):
        entries = [("text", i, f"flag.{i}", f"route.{i}") for i in range(n)]
        engine = Engine([Rule("All", F.lit(True), ["text"])], RulesTable(entries))
        documents = h.documents(spark, ("x", []))
        bodies = ['{"id":"%s"%s}' % (h.hex_id(0), "" if i % 9 else ', "reset": ["flag.3"]') for i in range(400)]
        tables_ = []
        table = plan.Work.table
        monkeypatch.setattr(plan.Work, "table", lambda self, *a, t=table: tables_.append(1) or t(self, *a))
        log = supervise_log(h.messages(spark, *bodies), documents, engine, hot_messages=10, piece_messages=25)
        monkeypatch.setattr(plan.Work, "table", table)
        cold = supervise_log(h.messages(spark, *bodies), documents, engine)
        assert outcome(log.results) == outcome(cold.results)
        assert changed(log.documents) == changed(cold.documents)
        passes.append(len(tables_))
    assert passes[0] == passes[1]


@pytest.mark.parametrize("bytes_", [0, plan.BROADCAST_BYTES])
def test_pieces_joined_or_broadcast_equal_the_model(tables, expected, monkeypatch, bytes_):
    monkeypatch.setattr(plan, "BROADCAST_BYTES", bytes_)
    documents, messages = tables
    log = supervise_log(messages, documents, Engine.default(True), hot_messages=5, piece_messages=40)
    assert outcome(log.results) == expected[0]


def test_any_resolver_equals_the_model(tables, expected):
    """The same engine, given as a function that nothing is known of."""
    documents, messages = tables
    engine = Engine.default(True)
    log = supervise(messages, documents, lambda docs: engine.resolve(docs), engine.table)
    assert outcome(log.results) == expected[0]
    assert changed(log.documents) == expected[1]
    assert log.sends.count() == sum(len(r[2]) for r in expected[0].values())
    log.work.remove()


def test_conditions_on_flags_see_the_flags_of_the_moment(spark, tables):
    import tests.helpers as h

    idle = ~F.exists("doclib", lambda flag: F.coalesce(flag["queued"], F.lit(False)))
    engine = Engine([Rule("Idle", idle, ["text"])])
    documents = h.documents(spark, ("x", []))
    body = '{"id":"%s"}' % h.hex_id(0)
    again = '{"id":"%s","reset":["rawtext"]}' % h.hex_id(0)
    log = supervise(h.messages(spark, body, again, body), documents, engine)
    assert [r.status for r in log.results.orderBy("seq").collect()] == ["sent", "no_match", "no_match"]
    with pytest.raises(ValueError, match="looks at the flags"):
        supervise_log(h.messages(spark, body), documents, engine)


FAILED = ("undecodable", "missing_document", "reset_without_start")


def write_in_parts(messages, source, edges):
    for low, high in zip(edges, edges[1:]):
        part = messages.filter((F.col("seq") >= low) & (F.col("seq") < high))
        part.coalesce(1).write.mode("append").parquet(source)


def test_stream_equals_the_model(spark, tables, expected, tmp_path):
    documents, messages = tables
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    write_in_parts(messages, source, [0, 300, 301, 500, 800, 2_000])
    stream = read_messages(spark, source, stream=True, files_per_trigger=1)
    store = lambda: documents
    supervise_stream(
        stream, store, Engine.default(True), out, f"{tmp_path}/checkpoint", available_now=True, compact_every=2
    ).awaitTermination()
    results = read_output(spark, out, "results")
    assert results.select("batch_id").distinct().count() == 5
    assert outcome(results) == expected[0]
    assert read_output(spark, out, "sends").count() == sum(len(r[2]) for r in expected[0].values())
    assert read_output(spark, out, "dead_letters").count() == sum(r[0] in FAILED for r in expected[0].values())
    now = current_documents(spark, store, out, 5)
    assert {i: f for i, f in changed(now).items() if i in expected[1]} == expected[1]
    assert now.count() == documents.count()

    # A repeated batch replaces its own output, also under another interval.
    last = messages.filter(F.col("seq") >= 800)
    for compact_every in (2, 3, 20):
        supervise_batch(last, 4, store, Engine.default(True), out, compact_every)
        assert outcome(read_output(spark, out, "results")) == expected[0]
        now = current_documents(spark, store, out, 5)
        assert {i: f for i, f in changed(now).items() if i in expected[1]} == expected[1]


def test_stream_follows_a_live_store(spark, tables, tmp_path):
    """Between batches a consumer ends a flag, and a document arrives."""
    import tests.helpers as h

    archive = "application/zip"
    engine = Engine.default(True)
    first = h.documents(spark, (archive, []), ("text/plain", []))
    body = ['{"id":"%s"}' % h.hex_id(i) for i in range(3)]
    path, store = f"{tmp_path}/out", f"{tmp_path}/store"
    write_flags(first, first.limit(0).select("id", "doclib"), store)

    def handle(batch, *numbers):
        messages = h.messages(spark, *[body[i] for i in numbers])
        supervise_batch(messages.withColumn("seq", F.col("seq") + 10 * batch), batch, store, engine, path, 2)
        found = read_output(spark, path, "results").filter(F.col("batch_id") == batch).orderBy("seq")
        return [(r.status, r.stage_key) for r in found.collect()]

    assert handle(0, 0, 0, 2) == [("sent", "archive"), ("held", "archive"), ("missing_document", None)]
    # The consumer has unpacked it, and queued nothing further.
    done = h.documents(spark, (archive, [h.ended("unarchived")]))
    write_flags(first, done.select("id", "doclib"), store)
    assert handle(1, 0, 0) == [("sent", "analytical"), ("held", "analytical")]
    flags = {f.key: f for f in current_documents(spark, store, path, 2).filter(F.col("id") == h.hex_id(0)).first().doclib}
    assert set(flags) == {"unarchived", "analytical"} and flags["unarchived"].ended is not None
    # A document that was not there before.
    more = h.documents(spark, (archive, []), ("text/plain", []), ("text/plain", []))
    late = more.filter(F.col("id") == h.hex_id(2))
    now = read_documents(spark, store).drop("bucket")
    write_flags(now.unionByName(late), first.limit(0).select("id", "doclib"), f"{store}2")
    store = f"{store}2"
    assert handle(2, 2, 1) == [("sent", "ner"), ("sent", "ner")]


def test_a_mark_outlives_a_consumers_start(spark, tmp_path):
    """Sent, then consumed, then reset and sent again: the second mark holds."""
    import tests.helpers as h

    engine, path, text = Engine.default(True), f"{tmp_path}/out", '{"id":"%s"}' % h.hex_id(0)
    again = '{"id":"%s","reset":["rawtext"]}' % h.hex_id(0)
    statuses = []
    flags = []
    for batch, (body, second) in enumerate([(text, 10), (again, 20), (text, 21)]):
        store = h.documents(spark, ("application/msword", flags))
        message = h.messages(spark, body).selectExpr(
            f"{batch}L AS seq", f"TIMESTAMP_NTZ '2030-01-01 00:00:{second}' AS ts", "body"
        )
        supervise_batch(message, batch, lambda: store, engine, path)
        found = read_output(spark, path, "results").filter(F.col("batch_id") == batch)
        statuses += [(r.status, r.stage_key) for r in found.collect()]
        start = h.NOW.replace(year=2030, month=1, day=1, hour=0, minute=0, second=12, microsecond=0)
        flags = [("rawtext", None, start, start.replace(second=13), None, None)]
    assert statuses == [("sent", "text"), ("sent", "text"), ("held", "text")]


def test_bases_hold_what_the_store_does_not(spark, tmp_path):
    """Changes that the store has caught up with leave the base; older ones are removed."""
    import os

    from docroute.streaming.supervise_stream import changes

    import tests.helpers as h

    engine, path = Engine.default(True), f"{tmp_path}/out"
    body = ['{"id":"%s"}' % h.hex_id(i) for i in range(2)]
    store = h.documents(spark, ("application/zip", []), ("application/zip", []))
    for batch in range(4):
        if batch == 3:
            # A consumer has written down what the stream sent for the first document.
            done = [h.flag("unarchived", queued=True)]
            store = h.documents(spark, ("application/zip", done), ("application/zip", []))
        messages = h.messages(spark, body[batch % 2]).withColumn("seq", F.lit(batch).cast("long"))
        supervise_batch(messages, batch, lambda: store, engine, path, compact_every=2)
    kept = {r.id for r in spark.read.parquet(f"{path}/base/upto=3").collect()}
    assert kept == {h.hex_id(1)}
    assert sorted(os.listdir(f"{path}/base")) == ["upto=1", "upto=3"]
    assert sorted(os.listdir(f"{path}/changes")) == ["batch_id=2", "batch_id=3"]
    assert {r.id for r in changes(spark, path, 4).collect()} == {h.hex_id(1)}
    assert {r.id for r in changes(spark, path, 4, [h.hex_id(0)]).collect()} == set()


def scanned(df):
    """(rows that the scans of the plan gave, the result)"""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if "Scan parquet" in leaves.apply(i).nodeName()]
    return sum(scan.metrics().apply("numOutputRows").value() for scan in scans), rows


def test_few_documents_are_read_at_the_cost_of_few(spark, tmp_path, monkeypatch):
    """Of a store of many row groups, three hundred ids read a fraction."""
    from docroute.sources import documents as store

    monkeypatch.setattr(store, "ROW_GROUP_BYTES", 40_000)
    path = str(tmp_path / "store")
    docs = fixtures.documents(spark, SF, 200).drop("doc_id")
    total = docs.count()
    write_flags(docs, docs.limit(0).select("id", "doclib"), path, buckets=4)
    ids = docs.select("id").orderBy("id").limit(300)
    few = store.few_ids(ids)
    read, rows = scanned(store.read_named(spark, path, ids, few))
    assert sorted(r.id for r in rows) == sorted(few) and len(few) == 300
    assert total == 40_000 and read < total / 4
    # Too many to be looked up one by one: joined.
    many = store.read_named(spark, path, ids, None)
    assert sorted(r.id for r in many.collect()) == sorted(few)


def intervals_of(documents, messages, engine, work):
    """The rows that a resolver is given in the last pass, and in all."""
    seen = []

    def resolve(docs):
        seen.append(docs.count())
        return engine.resolve(docs)

    log = supervise(messages, documents, resolve, engine.table)
    return seen, log


def test_a_resolver_is_asked_once_per_interval(spark, tables):
    """A document without resets, whose flags change twice, is three intervals,
    however many messages it has."""
    import tests.helpers as h

    engine = Engine.default(True)
    documents = h.documents(spark, ("text/csv", []), ("application/msword", []))
    body = ['{"id":"%s"}' % h.hex_id(i) for i in range(2)]
    again = '{"id":"%s","reset":["rawtext"]}' % h.hex_id(1)
    bodies = [body[0]] * 200 + [body[1], body[1], again, body[1], body[1], again] + [body[1]] * 100
    seen, log = intervals_of(documents, h.messages(spark, *bodies), engine, None)
    closed = supervise(h.messages(spark, *bodies), documents, engine)
    assert outcome(log.results) == outcome(closed.results)
    # Intervals: one and the first sends of the first document; the second's also
    # begin anew with each of its two resets.  A log is cut into at most eight pieces.
    sends = {s.flag for r in log.results.filter(F.col("id") == h.hex_id(0)).collect() for s in r.sends}
    changes = len({r.seq for r in log.results.collect() if r.sends})
    assert sends and seen[-1] <= 2 + changes + 2 + 8
    assert sum(seen) < len(bodies)


def test_intermediate_tables_are_removed(spark, tables):
    from docroute.sources.documents import exists

    documents, messages = tables
    log = supervise_log(messages, documents, Engine.default(True), hot_messages=50)
    assert exists(spark, log.work.path)
    log.work.remove()
    assert not exists(spark, log.work.path)
