"""Tables that grow with the documents are not broadcast, whatever their files' size,
and few files are not few tasks."""

import re

import pytest
from pyspark.sql import functions as F

from docroute import fixtures
from docroute.operators.engine import Engine
from docroute.plans import supervise_log as plan
from docroute.plans.supervise import supervise
from docroute.plans.supervise_log import supervise_log
from docroute.schema import RESOLUTION_TYPE
from docroute.sources.messages import read_messages
from docroute.streaming import supervise_stream as stream
from tests import helpers as h
from tests.helpers import ended, hex_id


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_many_ids_are_neither_broadcast_nor_repeated(spark, tmp_path, monkeypatch, how):
    monkeypatch.setattr(plan, "BROADCAST_IDS", 0)
    monkeypatch.setattr(plan, "PART_MESSAGES", 5)
    spark.range(40).selectExpr("id AS seq", "CASE WHEN id < 30 THEN 'a' WHEN id < 35 THEN 'b' ELSE 'c' END AS id").write.parquet(f"{tmp_path}/m")
    spark.createDataFrame([("a",), ("b",), ("b",), ("x",), (None,)], "id string").write.parquet(f"{tmp_path}/i")
    met = plan.restrict(spark.read.parquet(f"{tmp_path}/m"), spark.read.parquet(f"{tmp_path}/i"), 3, how)
    joins = re.findall(r"(\w+Join) .*?Left(?:Semi|Anti)", planned(met))
    assert joins == ["SortMergeJoin"]
    wanted = range(35) if how == "left_semi" else range(35, 40)
    assert sorted(r.seq for r in met.collect()) == list(wanted)
    assert met.columns == ["id", "seq"]


def send_all(documents):
    sends = "array(named_struct('ordinal', 0, 'flag', 'flag.one', 'route', 'flag.one'))"
    resolution = f"named_struct('rule', 'All', 'stage_key', 'flag-test', 'sends', {sends}, 'error', NULL)"
    return documents.withColumn("resolution", F.expr(resolution).cast(RESOLUTION_TYPE))


def test_rounds_of_many_documents_join_without_broadcast(spark, monkeypatch):
    documents = h.documents(spark, *[("text/plain", [ended("rawtext")])] * 4)
    bodies = [f'{{"id":"{hex_id(i % 5)}"}}' for i in range(9)] + [f'{{"id":"{hex_id(1)}","reset":["flag.one"]}}']
    few = supervise(h.messages(spark, *bodies), documents, send_all, h.FLAG_TEST_TABLE).results
    known = sorted(map(str, few.collect()))
    assert [r.status for r in few.orderBy("seq").collect()] == ["sent"] * 4 + ["missing_document"] + ["held"] * 4 + ["sent"]

    monkeypatch.setattr(plan, "BROADCAST_IDS", 0)
    monkeypatch.setattr(plan, "BROADCAST_BYTES", 0)
    log = supervise(h.messages(spark, *bodies), documents, send_all, h.FLAG_TEST_TABLE)
    assert sorted(map(str, log.results.collect())) == known
    assert not re.search(r"BroadcastHashJoin .*(Inner|LeftSemi|LeftAnti)", planned(log.results))
    assert not re.search(r"BroadcastHashJoin .*(Inner|LeftSemi|LeftAnti)", planned(log.documents))


def test_logs_of_many_messages_join_without_broadcast(spark, tmp_path, monkeypatch):
    h.documents(spark, *[("text/plain", [ended("rawtext")])] * 4).write.parquet(f"{tmp_path}/d")
    documents = spark.read.parquet(f"{tmp_path}/d")
    sent = h.messages(spark, *[f'{{"id":"{hex_id(i % 5)}"}}' for i in range(9)])
    known = sorted(map(str, supervise_log(sent, documents, Engine.default()).results.collect()))
    monkeypatch.setattr(plan, "BROADCAST_BYTES", 0)
    results = supervise_log(sent, documents, Engine.default()).results
    assert "BroadcastHashJoin" not in planned(results)
    assert sorted(map(str, results.collect())) == known


def test_batches_of_few_files_are_decoded_by_all_cores(spark, tmp_path, monkeypatch):
    h.documents(spark, *[("text/plain", [])] * 3).write.parquet(f"{tmp_path}/store")
    h.messages(spark, *[f'{{"id":"{hex_id(i % 4)}"}}' for i in range(40)]).coalesce(1).write.parquet(f"{tmp_path}/in")
    met, decode = [], stream.decode_messages
    monkeypatch.setattr(stream, "decode_messages", lambda rows: met.append(rows.rdd.getNumPartitions()) or decode(rows))
    stream.supervise_batch(read_messages(spark, f"{tmp_path}/in"), 0, f"{tmp_path}/store", Engine.default(), f"{tmp_path}/out")
    assert met == [spark.sparkContext.defaultParallelism]
    assert stream.read_output(spark, f"{tmp_path}/out", "results").count() == 40


def test_one_file_of_events_is_read_into_all_cores(spark, tmp_path):
    rows = "id AS event_id, TIMESTAMP '2024-01-01 00:00:00' AS ts, 'error' AS event_type"
    spark.range(200).selectExpr(*rows.split(", ")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    messages = fixtures.messages(spark, str(tmp_path))
    assert messages.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted(r.seq for r in messages.collect()) == list(range(200))
