"""The registered text queries on the given tables, against their SQL where there
is one and otherwise against what must hold for any input."""

import duckdb
import pytest

import check
from docroute.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_equals_sql(spark, con, name):
    assert check.compare(spark, con, name, SF).startswith("same")


PER_DOCUMENT = ["op2_language_id", "op3_token_counts", "op4_byte_bpe", "op7_token_files", "op10_lm_scores"]


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_document(spark, con, name):
    ids = sorted(r.doc_id for r in queries.queries()[name](spark, SF).select("doc_id").collect())
    assert ids == [r[0] for r in con.execute("SELECT doc_id FROM documents ORDER BY 1").fetchall()]


def test_held_out_texts_are_known_better_than_by_single_words(spark):
    rows = [r for r in queries.op10_lm_scores(spark, SF).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_held_out_languages(spark):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    rows = [r for r in queries.op2_language_id(spark, SF).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) / len(rows) >= 0.95
