"""Documents, flags and messages derived from the given tables.

The given tables carry no mimetypes and no flags, so both follow from the
document number by rule, and the messages from the events.  All of it is one
projection per table, without a join; tables of few files are dealt out first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docroute.functions.flags import strings_sql
from docroute.schema import FLAGS_TYPE
from docroute.sources.messages import deal_out

# Mimetypes in turn, and the flags a document may carry.
MIMETYPES = [
    "application/gzip",
    "application/vnd.ms-cab-compressed",
    "application/vnd.ms-excel",
    "text/csv",
    "text/tab-separated-values",
    "text/tab-custom",
    "text/html",
    "text/webviewhtml",
    "text/html; charset=utf-8",
    "application/xml",
    "image/svg+xml",
    "text/plain",
    "message/rfc822",
    "text/x-python",
    "application/msword",
    "application/rtf",
    "application/pdf",
    "application/pdf",
    "chemical/x-inchi",
    "image/png",
    "audio/wav",
    "video/mpeg",
    "dummy/mimetype",
    "application/x-tar",
]

FLAG_KEYS = [
    "unarchived",
    "tabular.totsv",
    "tabular.analysis",
    "rawtext",
    "pdf.intermediates",
    "bounding_box",
    "analytical",
    "ner.leadmine.chemblactivityterms",
    "ner.leadmine.chemicalentities",
    "ner.leadmine.chemicalidentifiers",
    "ner.leadmine.poseidon",
    "ner.leadmine.geneprotein",
]


def _hex_id_sql(number: str) -> str:
    return f"lpad(lower(hex({number})), 24, '0')"


def _numbers(spark: SparkSession, sf_dir: str, copies: int) -> DataFrame:
    numbers = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    # A small table is one task until it is dealt out.
    if copies == 1:
        return deal_out(numbers)
    return (
        numbers.selectExpr("doc_id", f"explode(sequence(0, {copies - 1})) AS copy")
        .selectExpr(f"doc_id * {copies} + copy AS doc_id")
        .repartition(spark.sparkContext.defaultParallelism * 4)
    )


def documents(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """(id, doc_id, mimetype, doclib); with ``copies``, as many documents with
    numbers of their own for each given one."""
    version = "named_struct('number', '0.0.1', 'major', 0, 'minor', 0, 'patch', 1, 'hash', '1234567890')"
    state = "((doc_id + 1) * (2 * k + 3) * 7919 + k * 104729) % 1009 % 10"
    states = (
        f"filter(transform({strings_sql(FLAG_KEYS)}, (key, k) ->"
        f" named_struct('key', key, 'k', k, 's', {state})), x -> x.s >= 2)"
    )
    flag = (
        f"named_struct('key', x.key, 'version', {version},"
        " 'started', CASE WHEN x.s >= 3 THEN t0 END,"
        " 'ended', CASE WHEN x.s >= 4 THEN t0 + INTERVAL '60' SECOND END,"
        " 'reset', CASE WHEN x.s = 8 THEN t0 + INTERVAL '600' SECOND"
        " WHEN x.s = 9 AND x.k % 2 = 1 THEN t0 + INTERVAL '0.5' SECOND"
        " WHEN x.s = 9 THEN t0 - INTERVAL '600' SECOND"
        " WHEN x.s = 2 AND doc_id % 5 = 0 THEN t0 END,"
        " 'queued', CASE WHEN x.s IN (2, 3) THEN true WHEN x.s = 8 AND doc_id % 3 = 0 THEN true"
        " WHEN x.s = 7 THEN false END)"
    )
    older = (
        f"named_struct('key', x.key, 'version', {version},"
        " 'started', t0 - INTERVAL '86400' SECOND, 'ended', t0 - INTERVAL '86340' SECOND,"
        " 'reset', CAST(NULL AS TIMESTAMP_NTZ), 'queued', true)"
    )
    duplicated = (
        "filter(states, x -> (x.s = 6 AND doc_id % 4 = 0) OR (x.s = 8 AND doc_id % 7 = 0))"
    )
    return (
        _numbers(spark, sf_dir, copies)
        .selectExpr(
            f"{_hex_id_sql('doc_id')} AS id",
            "doc_id",
            f"get({strings_sql(MIMETYPES)}, CAST(doc_id % {len(MIMETYPES)} AS INT)) AS mimetype",
            "TIMESTAMP_NTZ '2024-01-01 00:00:00.25' + make_dt_interval(0, 0, 0, doc_id) AS t0",
            f"{states} AS states",
        )
        .selectExpr(
            "id",
            "doc_id",
            "mimetype",
            f"CAST(concat(transform(states, x -> {flag}), transform({duplicated}, x -> {older}))"
            f" AS {FLAGS_TYPE.simpleString()}) AS doclib",
        )
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, ts, body)"""
    document = _hex_id_sql("event_id div 9")
    key = f"get({strings_sql(FLAG_KEYS)}, CAST(event_id % {len(FLAG_KEYS)} AS INT))"
    body = (
        "CASE WHEN event_id % 97 = 0 THEN 'not json'"
        """ WHEN event_id % 89 = 0 THEN '{"reset":["rawtext"]}'"""
        f""" WHEN event_type = 'error' THEN concat('{{"id":"', {document}, '","reset":["rawtext","', {key}, '"]}}')"""
        f""" ELSE concat('{{"id":"', {document}, '"}}') END"""
    )
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type")
    return deal_out(events).selectExpr(
        "event_id AS seq", "CAST(ts AS TIMESTAMP_NTZ) AS ts", f"{body} AS body"
    )


def hot_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages, a third of which name one document and a seventh one that
    does not exist."""
    key, hot, missing = '"id":"[0-9a-f]{24}"', f'"id":"{16:024x}"', f'{{"id":"{999_999_999:024x}"}}'
    body = (
        f"CASE WHEN seq % 7 = 1 THEN '{missing}'"
        f" WHEN seq % 3 = 0 THEN regexp_replace(body, '{key}', '{hot}') ELSE body END"
    )
    return messages(spark, sf_dir).selectExpr("seq", "ts", f"{body} AS body")


def interleaved_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages in another order, every document's first ones first, each ninth
    of them an hour after the one before."""
    turn, start = "CAST(seq % 9 AS INT)", "TIMESTAMP_NTZ '2030-01-01 00:00:00'"
    return messages(spark, sf_dir).selectExpr(
        f"{turn} * 1000000000000 + seq AS seq", f"{start} + make_dt_interval(0, {turn}) AS ts", "body"
    )
