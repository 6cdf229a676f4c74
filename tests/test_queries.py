"""Every registered query against its SQL, on whole tables."""

import re

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


# The text operators have tests of their own.
NAMES = [name for name in entry.queries() if not re.match(r"op\d+_|pipeline", name)]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    verdict = check.compare(spark, con, name, SF)
    assert verdict.startswith(("same", "rows only")), verdict


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_log_and_stream_agree(spark):
    log = entry.supervise_log(spark, SF)
    stream = entry.supervise_stream(spark, SF).select(log.columns)
    assert log.exceptAll(stream).count() == 0 and stream.exceptAll(log).count() == 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["stage_key", "route", "n_docs"] and df.count() > 0
