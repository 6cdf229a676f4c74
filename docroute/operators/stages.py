"""Long-form views of the stages: one row per document, stage and entry.

The entries are literals in the row, so these multiply rows without a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.functions import flags as ff
from docroute.functions.flags import let_sql, quote, strings_sql
from docroute.sources.rules import RulesTable


def head_flags(documents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key against every document: is there such a flag, and the first one."""
    rows = F.array(
        *[
            F.struct(F.lit(key).alias("flag_key"), ff.has_flag(key).alias("has_flag"), ff.head_flag(key).alias("head"))
            for key in keys
        ]
    )
    fields = ["started", "ended", "reset", "queued"]
    return documents.select("id", F.inline(rows)).select("id", "flag_key", "has_flag", *[f"head.{c}" for c in fields])


def sends_of(selected: DataFrame, sends: str = "sends") -> DataFrame:
    """The sends in long form: (id, stage_key, flag, route)."""
    rows = selected.selectExpr("id", "resolution.stage_key AS stage_key", f"inline_outer({sends})")
    return rows.filter("route IS NOT NULL").drop("ordinal")


def flag_rows(documents: DataFrame) -> DataFrame:
    """The flags in long form, one row per document and entry."""
    rows = documents.selectExpr("id", "inline_outer(doclib)")
    return rows.filter("key IS NOT NULL").withColumnRenamed("key", "flag_key")


def _entries_sql(table: RulesTable) -> str:
    rows = [
        f"named_struct('stage_key', {quote(e.stage_key)}, 'ordinal', {e.ordinal},"
        f" 'flag', {quote(e.flag)}, 'route', {quote(e.route)})"
        for e in table.entries
    ]
    return f"array({', '.join(rows)})"


def _with_allowed(documents: DataFrame, table: RulesTable, analytical_flag: str) -> DataFrame:
    flags = strings_sql([e.flag for e in table.entries])
    allowed = ff.sendable_allowed_each_sql(flags, analytical_flag=analytical_flag)
    return documents.select("id", F.expr(allowed).alias("__allowed"))


def required_entries(
    documents: DataFrame, table: RulesTable, analytical_flag: str = ff.ANALYTICAL_FLAG
) -> DataFrame:
    """Every required entry against every document: may it be sent?

    ``allowed`` is NULL where the flag was reset without having started.
    """
    entries = (
        f"transform({_entries_sql(table)}, (e, i) -> named_struct('stage_key', e.stage_key,"
        " 'ordinal', e.ordinal, 'flag', e.flag, 'route', e.route, 'allowed', __allowed[i]))"
    )
    return _with_allowed(documents, table, analytical_flag).selectExpr("id", f"inline_outer({entries})")


def stage_sendables(
    documents: DataFrame, table: RulesTable, analytical_flag: str = ff.ANALYTICAL_FLAG
) -> DataFrame:
    """The allowed entries of every stage, whatever the document is; a stage
    that meets an error has none."""
    entries = _entries_sql(table)
    unsound = (
        f"array_compact(transform({entries}, (e, i) -> CASE WHEN __allowed[i] IS NULL THEN e.stage_key END))"
    )
    allowed = let_sql(
        unsound,
        "unsound",
        f"filter({entries}, (e, i) -> __allowed[i] AND NOT array_contains(unsound, e.stage_key))",
    )
    rows = _with_allowed(documents, table, analytical_flag).selectExpr("id", f"inline_outer({allowed})")
    return rows.filter("route IS NOT NULL")


def stage_progress(documents: DataFrame, table: RulesTable) -> DataFrame:
    """For every stage: have all required flags ended, do all of them exist?"""
    rows = F.array(
        *[
            F.struct(
                F.lit(key).alias("stage_key"),
                ff.completed(table.flags(key)).alias("completed"),
                ff.started(table.flags(key)).alias("started_all"),
            )
            for key in table.stages()
        ]
    )
    return documents.select("id", F.inline(rows))


def queued_flags(documents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key against every document: has an entry of it been queued?"""
    rows = [F.struct(F.lit(key).alias("flag"), ff.is_queued(key).alias("is_queued")) for key in keys]
    return documents.select("id", F.inline(F.array(*rows)))


def queueable_flags(rows: DataFrame, keys: Sequence[str], reset: str, *columns: str) -> DataFrame:
    """Every key against every row of messages with documents: may it be queued,
    given the list in the column ``reset``?"""
    tested = [F.struct(F.lit(key).alias("flag"), ff.can_queue(key, reset).alias("can_queue")) for key in keys]
    return rows.select(*columns, F.inline(F.array(*tested)))


def matched_entries(resolved: DataFrame, table: RulesTable) -> DataFrame:
    """The allowed entries of the stage that a document resolved to, as ``sends``
    that may name a queue more than once."""
    allowed = stage_sendables(resolved, table).groupBy("id", "stage_key").agg(
        F.array_sort(F.collect_list(F.struct("ordinal", "flag", "route"))).alias("sends")
    )
    chosen = resolved.filter("resolution.error IS NULL").select("id", "resolution")
    return chosen.withColumn("stage_key", F.col("resolution.stage_key")).join(allowed, ["id", "stage_key"]).drop("stage_key")
