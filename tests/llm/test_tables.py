"""What operators leave behind, and that their passes agree."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docroute.llm import ann, exact_dedup, exchange, files, lm, ngram_join, packing, phrases, substring, suffixes
from docroute.llm.tables import finished
from docroute.llm.text import BATCH_BYTES, short_batches
from docroute.llm.tokenise import encoder, tokenizer_file
from tests.llm.helpers import awkward_rows, rows_of, sentences, written

PASSES = [substring.substring_digests, ngram_join.near_copies, lm.score, substring.remove_repeated]
CORES = "spark.sql.leafNodeDefaultParallelism"


@pytest.mark.parametrize("operator", PASSES)
def test_passes_see_the_same_splits_when_cores_change(spark, tmp_path, monkeypatch, operator):
    rows = awkward_rows() + [(900 + i, sentences(i % 30, 400)) for i in range(60)]
    docs = written(spark, tmp_path / "docs", rows, files=2)
    want = rows_of(operator(docs))
    returned = exchange.returned

    def change(*args, **kwargs):
        out = returned(*args, **kwargs)
        spark.conf.set(CORES, "7")
        return out

    monkeypatch.setattr(exchange, "returned", change)
    try:
        spark.conf.set(CORES, "2")
        assert rows_of(operator(docs)) == want
    finally:
        spark.conf.unset(CORES)


def vectors(spark, path):
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(50)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_only_results_stay(spark, tmp_path):
    docs, words = written(spark, tmp_path / "docs", awkward_rows()), tokenizer_file("word_bpe_49k.json")
    folder = spark.conf.get("spark.checkpoint.dir")
    settings = ["spark.sql.files.minPartitionNum", "spark.sql.execution.arrow.maxRecordsPerBatch"]
    before = [spark.conf.get(key, None) for key in settings]
    for run in (
        lambda: substring.substring_digests(docs),
        lambda: ngram_join.drop_near_copies(docs),
        lambda: lm.score(docs),
        lambda: exact_dedup.exact_dedup(docs),
        lambda: exact_dedup.drop_copies(docs),
        lambda: packing.pack_documents(docs, words),
        lambda: suffixes.remove_repeated_bytes(docs),
        lambda: phrases.collocations(docs),
        lambda: ann.nearest(vectors(spark, tmp_path / f"v{len(os.listdir(tmp_path))}")),
    ):
        there = set(os.listdir(folder))
        result = run()
        assert len(set(os.listdir(folder)) - there) == 1
        result.count()
    assert spark.conf.get(settings[0], None) == before[0]


def test_an_operator_that_fails_leaves_nothing(spark, tmp_path, monkeypatch):
    docs = written(spark, tmp_path / "docs", awkward_rows())
    folder = spark.conf.get("spark.checkpoint.dir")
    there = set(os.listdir(folder))
    monkeypatch.setattr(substring, "kept_bytes", None)
    with pytest.raises(Exception):
        substring.substring_digests(docs)
    assert not {f for f in set(os.listdir(folder)) - there if "digests" not in f}


@pytest.mark.parametrize("path", ["s3a://b/x/y", "s3n://b/x/y", "dbfs:/x/y", "file:///tmp/y", "file:/tmp/y", "/tmp/y"])
def test_folders_of_other_stores(monkeypatch, path):
    from pyarrow import fs

    asked = []
    monkeypatch.setattr(fs, "FileSystem", type("F", (), {"from_uri": staticmethod(lambda uri: asked.append(uri))}))
    files.store(path)
    assert asked == [{"s3a": "s3://b/x/y", "s3n": "s3://b/x/y", "dbfs": "/dbfs/x/y", "file": "/tmp/y"}.get(path.partition(":")[0], path)]


def batch_sizes(rows):
    def size(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)]), pa.array([batch.nbytes])], ["rows", "bytes"])

    return rows.mapInArrow(size, "rows long, bytes long")


def test_batches_of_long_rows_are_bounded_in_bytes(spark):
    long = 300_000
    rows = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), long).alias("text"))
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = {key: spark.conf.get(key, None) for key in keys}
    try:
        for key in keys:
            spark.conf.unset(key)
        operator = finished(batch_sizes)
        runs = [operator(rows).collect()]
        short_batches(spark)
        runs.append(batch_sizes(rows).collect())
        spark.conf.set(keys[1], "4m")
        short_batches(spark)
        assert spark.conf.get(keys[1]) == "4m"
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    for run in runs:
        assert sum(r["rows"] for r in run) == 40
        assert max(r["bytes"] for r in run) < BATCH_BYTES + 2 * long


def test_a_worker_drops_its_encoder_when_it_turns_to_other_work():
    path = tokenizer_file("word_bpe_49k.json")
    first = encoder(path)
    assert encoder(path) is first
    assert list(exchange.blocks(iter([]))) == []
    assert encoder(path) is not first


def test_slots_need_no_python_worker(spark):
    planned = packing.plan({7: 5, 3: 900, 2048: 2}, 2048)
    found = packing._slots(spark, planned, 2)
    assert "ExistingRDD" not in found._jdf.queryExecution().toString()
    told = [(r.length, run.first, run.sequence, run.offset) for r in found.collect() for part in r.blocks for run in part.runs]
    assert sorted(told) == sorted((length, first, sequence, offset) for length, first, _, sequence, offset in planned)
    assert all(part.first == part.runs[0].first for r in found.collect() for part in r.blocks)
    assert packing._slots(spark, []).collect() == []
