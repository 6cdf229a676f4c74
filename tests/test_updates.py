"""Decoding, resets, queueing and the handling of single messages."""

from datetime import timedelta

import pytest

from pyspark.sql import functions as F

from docroute.functions import flags as ff
from docroute.operators import updates
from docroute.operators.engine import Engine, distinct_routes
from docroute.plans.supervise import supervise
from docroute.schema import RESOLUTION_TYPE
from docroute.sources.documents import read_documents, write_flags
from docroute.sources.messages import decode_messages
from docroute.sources.sinks import publish, read_published
from tests import helpers as h
from tests.helpers import NOW, begun, ended, flag, hex_id

DECODE = [
    ('{"id":"%s"}' % hex_id(1), None, None),
    ('{"id":"0123456789ABCDEFabcdef00"}', None, None),
    ('{"id":"%s","reset":null}' % hex_id(1), None, None),
    ('{"id":"%s","reset":[]}' % hex_id(1), [], None),
    ('{"reset":["a","b"],"id":"%s","more":{"x":[{"y":1} ]}}' % hex_id(1), ["a", "b"], None),
    ('{"id":"1234"}', None, "bad_id"),
    ('{"id":"%sg"}' % hex_id(1)[1:], None, "bad_id"),
    *[
        (body, None, "undecodable")
        for body in [
            None,
            "",
            "not json",
            "null",
            "[1]",
            '"text"',
            '{"id":1}',
            '{"id":null}',
            '{"reset":["a"]}',
            '{"id":"%s","reset":"a"}' % hex_id(1),
            '{"id":"%s","reset":{}}' % hex_id(1),
            '{"id":"%s","reset":[1]}' % hex_id(1),
            '{"id":"%s","reset":["a",1]}' % hex_id(1),
            '{"id":"%s","reset":["a",null]}' % hex_id(1),
            '{"id":"%s","reset":[null]}' % hex_id(1),
            '{"id":"%s"} more' % hex_id(1),
            '{"id":"%s"}, 1' % hex_id(1),
            '{"id":"%s"}] more' % hex_id(1),
            '{"id":"%s"} ]}' % hex_id(1),
        ]
    ],
]


def test_decode_is_strict(spark):
    rows = decode_messages(h.messages(spark, *[d[0] for d in DECODE])).orderBy("seq").collect()
    assert [(r.reset, r.reason) for r in rows] == [d[1:] for d in DECODE]
    assert [r.ok for r in rows] == [d[2] != "undecodable" for d in DECODE]
    assert rows[1].id == "0123456789abcdefabcdef00"
    assert all(r.id is None for r in rows if r.reason == "undecodable")


HOUR = NOW + timedelta(hours=1)
RESETTABLE = [
    ended("first.flag"),
    flag("first.flag", HOUR, HOUR + timedelta(minutes=1)),
    ended("second.flag"),
    ended("third.flag"),
]


def test_reset_collapses_and_stamps(spark):
    df = h.documents(spark, ("application/pdf", RESETTABLE), ("application/pdf", RESETTABLE))
    body = '{"id":"%s","reset":["first.flag","second.flag","no.flag"]}' % hex_id(0)
    decoded = decode_messages(h.messages(spark, body, '{"id":"%s"}' % hex_id(1)))
    ts = h.messages(spark, body).first().ts
    reset, untouched = updates.reset_flags(df, decoded).orderBy("id").collect()
    assert [(f.key, f.started, f.ended, f.reset) for f in reset.doclib] == [
        ("first.flag", HOUR, HOUR + timedelta(minutes=1), ts),
        ("second.flag", NOW, NOW, ts),
        ("third.flag", NOW, NOW, None),
    ]
    assert [tuple(f)[0:1] + tuple(f)[2:] for f in untouched.doclib] == [f[0:1] + f[2:] for f in RESETTABLE]
    changed = updates.reset_changed(decoded, df).orderBy("seq")
    assert [r.changed for r in changed.collect()] == [True, True]


def test_reset_of_unknown_flags_changes_nothing(spark):
    df = h.documents(spark, ("x", [begun("a")]), ("x", []))
    decoded = decode_messages(
        h.messages(spark, *['{"id":"%s","reset":["b"]}' % hex_id(i) for i in (0, 1)])
    )
    assert [r.changed for r in updates.reset_changed(decoded, df).collect()] == [False, False]
    assert updates.reset_flags(df, decoded).exceptAll(df).count() == 0


def test_latest_flag_prefers_the_last_start_and_then_the_first_entry(spark):
    flags = [flag("a"), begun("a", queued=False), begun("a", queued=True), flag("b"), flag("b", queued=True)]
    row = updates.latest_flag_per_key(h.documents(spark, ("x", flags))).first()
    assert [(f.key, f.started, f.queued) for f in row.doclib] == [("a", NOW, False), ("b", None, None)]


def test_can_queue(spark):
    df = h.documents(
        spark,
        ("x", [ended("tabular.totsv", queued=False)]),
        ("x", [ended("tabular.totsv", queued=True)]),
        ("x", [ended("tabular.totsv"), begun("tabular.totsv", queued=True)]),
        ("x", []),
    ).withColumn("reset", F.array(F.lit("tabular.totsv")))
    rows = df.orderBy("id").select(
        ff.can_queue("tabular.totsv", "CAST(NULL AS array<string>)"), ff.can_queue("tabular.totsv")
    )
    assert [tuple(r) for r in rows.collect()] == [(True, True), (False, True), (False, True), (True, True)]


def test_flag_predicates(spark):
    df = h.documents(
        spark,
        ("x", []),
        ("x", [begun("a"), ended("a", reset=h.LATER)]),
        ("x", [ended("a", reset=h.LATER), ended("b", reset=h.EARLIER)]),
        ("x", [flag("a", reset=NOW)]),
    )
    def allowed(key, **more):
        return F.expr(f"get({ff.sendable_allowed_each_sql(ff.strings_sql([key]), **more)}, 0)")

    rows = df.orderBy("id").select(
        "doclib",  # where none of it is read as a whole, Spark 4.1 loses track of it
        ff.has_flag("a"),
        ff.head_flag("a")["ended"],
        ff.completed(["a"]),
        ff.completed(["a", "b"]),
        ff.completed([]),
        ff.started(["a", "b"]),
        ff.is_queued("a"),
    )
    assert [tuple(r)[1:] for r in rows.collect()] == [
        (False, None, False, False, True, False, False),
        (True, None, True, False, True, False, False),
        (True, NOW, True, True, True, True, False),
        (True, None, False, False, True, False, False),
    ]
    sent = df.orderBy("id").select("doclib", allowed("a"), allowed("b"), allowed("a", analytical_flag="a"))
    assert [tuple(r)[1:] for r in sent.collect()] == [
        (True, True, True),
        (False, True, True),
        (True, False, True),
        (None, True, True),
    ]


def test_distinct_routes_keeps_the_first(spark):
    sends = "array({})".format(
        ", ".join(
            f"named_struct('ordinal', {i}, 'flag', '{f}', 'route', '{r}')"
            for i, (f, r) in enumerate([("a", "q"), ("b", "r"), ("c", "q")])
        )
    )
    row = spark.range(1).select(F.expr(sends).alias("sends")).select(distinct_routes().alias("s")).first()
    assert [s.flag for s in row.s] == ["a", "b"]


def send_to(*names):
    """A resolver that always sends to these queues."""
    sends = ", ".join(
        f"named_struct('ordinal', {i}, 'flag', 'flag.{n}', 'route', 'flag.{n}')"
        for i, n in enumerate(names)
    )
    text = (
        f"named_struct('rule', 'Fixed', 'stage_key', '{h.FLAG_TEST}', 'sends', array({sends}), 'error', NULL)"
    )
    return lambda df: df.withColumn("resolution", F.expr(text).cast(RESOLUTION_TYPE))


ONE, TWO, THREE = (f"flag.{n}" for n in ("one", "two", "three"))


def handle_one(spark, flags, names, reset=()):
    df = h.documents(spark, ("application/pdf", flags))
    asked = ', "reset": [%s]' % ", ".join('"%s"' % r for r in reset) if reset else ""
    log = supervise(
        h.messages(spark, '{"id": "%s"%s}' % (hex_id(0), asked)), df, send_to(*names), h.FLAG_TEST_TABLE
    )
    queued = {f.key: f.queued for f in log.documents.first().doclib}
    return [s.route for s in log.results.first().sends], queued


def test_send_adds_the_flag(spark):
    sent, queued = handle_one(spark, [], ["one"])
    assert (sent, queued) == ([ONE], {ONE: True})


def test_queued_flags_are_not_sent_again(spark):
    flags = [begun(ONE, queued=True), begun(TWO, queued=False)]
    assert handle_one(spark, flags, ["one", "two"]) == ([TWO], {ONE: True, TWO: True})
    assert handle_one(spark, flags, ["one", "two", "three"]) == (
        [TWO, THREE],
        {ONE: True, TWO: True, THREE: True},
    )


def test_reset_overrides_queued(spark):
    flags = [begun(ONE, queued=True), begun(TWO, queued=False)]
    sent, queued = handle_one(spark, flags, ["one", "two", "three"], reset=[ONE])
    assert (sent, queued) == ([ONE, TWO, THREE], {ONE: True, TWO: True, THREE: True})


def test_supervise_outputs(spark, tmp_path):
    df = h.documents(
        spark,
        ("text/csv", []),
        ("application/pdf", [flag("rawtext", reset=NOW)]),
        ("application/gzip", [begun("unarchived")]),
        ("image/png", []),
    )
    bodies = ['{"id":"%s"}' % hex_id(i) for i in (0, 1, 2, 3, 9)] + ["x", '{"id":"12"}', '{"id":"%s"}' % hex_id(0)]
    done = supervise(h.messages(spark, *bodies), df, Engine.default())
    results = {r.seq: r for r in done.results.collect()}
    assert {seq: r.status for seq, r in results.items()} == {
        0: "sent",
        1: "reset_without_start",
        2: "held",
        3: "no_match",
        4: "missing_document",
        5: "undecodable",
        6: "bad_id",
        7: "sent",
    }
    assert {r.seq: r.reason for r in done.dead_letters.collect()} == {
        1: "reset_without_start",
        4: "missing_document",
        5: "undecodable",
        6: "bad_id",
    }
    assert results[7].stage_key == "tabular.analyse"
    assert done.sends.count() == 6 and results[0].rule == "Tabular"

    publish(done.results, str(tmp_path / "sends"))
    sent = read_published(spark, str(tmp_path / "sends"))
    assert sent.filter(F.col("body").contains(hex_id(0))).count() == 6
    assert sorted(map(tuple, sent.collect())) == sorted(map(tuple, done.sends.collect()))
    snapshot = write_flags(df, done.documents, str(tmp_path / "new"))
    again = read_documents(spark, str(tmp_path / "new")).orderBy("id").collect()
    assert snapshot.count() == 4
    assert [len(r.doclib) for r in again] == [6, 1, 1, 0]
    version = again[0].doclib[0].version
    assert tuple(version) == ("", 0, 0, 0, "")


def parquet_files(path):
    import os

    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_only_changed_buckets_are_written_anew(spark, tmp_path):
    df = h.documents(spark, *[("x", [begun("a")])] * 40).withColumn("extra", F.col("id"))
    path = str(tmp_path / "store")
    write_flags(df, df.limit(0).select("id", "doclib"), path, buckets=16)
    before = parquet_files(path)
    assert len(before) <= 16
    first = read_documents(spark, path, df.schema)
    new = h.documents(spark, ("x", [ended("a")]))
    after_write = write_flags(df, new.select("id", "doclib"), path)
    # One file more, none touched.
    assert before <= parquet_files(path) and len(parquet_files(path)) == len(before) + 1
    assert after_write.count() == 40 and after_write.columns == df.columns
    assert [r.id for r in after_write.collect() if r.doclib[0].ended] == [hex_id(0)]
    assert all(r.extra == r.id for r in after_write.collect())
    # Whoever reads the version before goes on.
    assert first.count() == 40 and not [r for r in first.collect() if r.doclib[0].ended]


def test_a_write_that_breaks_off_is_not_seen(spark, tmp_path, monkeypatch):
    from docroute.sources import documents as store

    df = h.documents(spark, *[("x", [begun("a")])] * 20)
    path = str(tmp_path / "store")
    write_flags(df, df.limit(0).select("id", "doclib"), path)
    new = df.select("id", F.expr("transform(doclib, f -> named_struct('key', 'b', 'version', f.version, 'started', f.started,"
                                 " 'ended', f.ended, 'reset', f.reset, 'queued', f.queued))").cast(df.schema["doclib"].dataType).alias("doclib"))  # fmt: skip
    write = store._write_buckets

    def broken(rows, folder, *more):
        write(rows.limit(5), folder, *more)
        raise RuntimeError("lost")

    monkeypatch.setattr(store, "_write_buckets", broken)
    with pytest.raises(RuntimeError, match="lost"):
        write_flags(df, new, path)
    keys = lambda: {f.key for r in read_documents(spark, path).collect() for f in r.doclib}
    assert keys() == {"a"}
    # Nor is one whose version is not complete.
    monkeypatch.setattr(store, "_write_buckets", write)
    write_flags(df, new, path)
    assert keys() == {"b"} and store.current_version(spark, path).number == 2
    (tmp_path / "store/versions/2/_SUCCESS").unlink()
    assert keys() == {"a"}


def test_old_versions_are_removed(spark, tmp_path):
    from docroute.sources.documents import current_version, remove_old_versions

    df = h.documents(spark, *[("x", [begun("a")])] * 30)
    path = str(tmp_path / "store")
    changed = df.filter(F.col("id") == hex_id(0)).select("id", "doclib")
    for _ in range(4):
        write_flags(df, changed, path)
    held = {f"{path}/{f}" for f in current_version(spark, path).folders.values()}
    files = len(parquet_files(path))
    remove_old_versions(spark, path, keep=1)
    assert len(parquet_files(path)) == files - 3
    assert {f.rpartition("/")[0] for f in parquet_files(path)} == held
    assert read_documents(spark, path).count() == 30 and current_version(spark, path).number == 4


def test_an_empty_store(spark, tmp_path):
    df = h.documents(spark, ("x", [begun("a")])).limit(0)
    path = str(tmp_path / "store")
    assert write_flags(df, df.select("id", "doclib"), path).count() == 0
    assert read_documents(spark, path).count() == 0


def test_keys_that_a_document_lacks_are_not_collected(spark):
    """A log that names very many keys for a document keeps its list at its own."""
    df = h.documents(spark, ("x", [begun("a"), begun("b")]))
    reset = F.concat(F.array(F.lit("a")), F.transform(F.sequence(F.lit(1), F.lit(50_000)), lambda i: F.concat(F.lit("k"), i)))
    message = spark.range(1).select(F.col("id").alias("seq"), F.lit(NOW).cast("timestamp_ntz").alias("ts"), F.lit(hex_id(0)).alias("id"), reset.alias("reset"))
    collected = updates.resets_per_document(updates.last_resets(message), df).first().resets
    assert [r.key for r in collected] == ["a"]
    flags = updates.reset_flags(df, message).first().doclib
    assert {f.key: f.reset for f in flags} == {"a": NOW, "b": None}


def test_latest_flags_of_a_long_history(spark):
    flags = [flag(f"k{i % 400}", NOW + timedelta(seconds=i % 7)) for i in range(1200)]
    row = updates.latest_flag_per_key(h.documents(spark, ("x", flags))).first()
    want = {}
    for key, _, started, *_ in flags:
        if key not in want or started > want[key]:
            want[key] = started
    assert {f.key: f.started for f in row.doclib} == want and len(row.doclib) == 400
