import random

import corpus_pipeline
from pyspark.sql import types as T

from docroute.llm import queries
from tests.llm.helpers import LOWER, awkward_rows, components, sentences, without_repeated
from tests.llm.test_tokens import crc, library_ids

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def classes(rows):
    """The class of every row, by number: a class is what links join."""
    own = [(i, t) for i, (_, t) in enumerate(rows)]
    return {i: c for i, _, c in components(own)}


def one_of_each(rows, key_of, order):
    """Of the rows with one key the least by this order."""
    best = {}
    for i, row in enumerate(rows):
        key = key_of(i)
        best[key] = min(best.get(key, i), i, key=lambda j: order(rows[j][0]))
    return [rows[i] for i in sorted(best.values())]


def expected(rows):
    """The rows that go into packing, stage by stage, in plain Python.  Of equal texts
    the largest id stays, null being smaller; of a class the smallest, null after all."""
    rows = [(d, t) for d, t in rows if t and any(c.isalpha() for c in t)]
    rows = one_of_each(rows, lambda i: rows[i][1].translate(LOWER), lambda d: (d is None, -(d or 0)))
    of = classes(rows)
    rows = one_of_each(rows, of.get, lambda d: (d is None, d or 0))
    return [(d, t if len(k) == len(w) else " ".join(k)) for (d, w, k), (_, t) in zip(without_repeated(rows), rows)]


def test_pipeline(spark, tmp_path):
    r = random.Random(0)
    rows = awkward_rows()
    for i in range(40):
        words = sentences(200 + i % 12, 80, 3000).split()
        words[r.randrange(80)] = f"changed{i}"
        rows.append((300 + i, " ".join(words) + (" " + sentences(900, 50, 3000) if i % 5 == 0 else "")))
    table = [(d, t, "en", "src", None if t is None else len(t)) for d, t in rows]
    spark.createDataFrame(table, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == SCHEMA.names
    want = expected(rows)
    assert sorted(((x.doc_id, x.text) for x in docs.collect()), key=repr) == sorted(want, key=repr)
    assert all(x.n_chars == len(x.text) for x in docs.collect())
    pieces = []
    for d, t in want:
        ids = library_ids("word_bpe_49k.json", t)
        pieces += [(d, k // 2048, k, len(ids[k : k + 2048]), crc(ids[k : k + 2048])) for k in range(0, len(ids), 2048)]
    got = [tuple(x)[:5] for x in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(pieces, key=repr)


def test_an_empty_table_goes_through_all_stages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_no_labels_lose_no_document(spark, tmp_path):
    rows = [x for x in awkward_rows() if x[0] is not None]
    table = [(d, t, None, "src", None if t is None else len(t)) for d, t in rows]
    spark.createDataFrame(table, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = corpus_pipeline.identify_languages(spark, docs, str(tmp_path))
    assert left.schema == docs.schema
    want = [(d, t) for d, t in rows if t and any(c.isalpha() for c in t)]
    assert sorted((x.doc_id, x.text) for x in left.collect()) == sorted(want)


def test_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert set(queries.oracle_sql()) <= set(names)
