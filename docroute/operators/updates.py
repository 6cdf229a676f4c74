"""Flag updates over whole collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.functions import flags as ff


def latest_flag_per_key(documents: DataFrame) -> DataFrame:
    """Collapse every key of every document to its most current flag."""
    return documents.withColumn("doclib", ff.latest_flag_per_key())


def last_resets(messages: DataFrame) -> DataFrame:
    """The last reset of every (id, key): grouped and pre-aggregated, so the
    number of messages for a document does not matter."""
    return (
        messages.select("id", "seq", "ts", F.explode(F.array_distinct("reset")).alias("key"))
        .groupBy("id", "key")
        .agg(F.max("seq").alias("seq"), F.max_by("ts", "seq").alias("ts"))
    )


def resets_per_document(resets: DataFrame, documents: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Collect the last resets of a document, restricted to the keys it has and
    the given ones, so that the list is never longer than these.

    Both sides of the joins have rows of documents, so they are sorted; Spark would go
    by the size of compressed files, and broadcast them."""
    more = F.array(*[F.lit(key) for key in keys]).cast("array<string>")
    named = documents.join(resets.select("id").distinct().hint("merge"), "id", "left_semi")
    own = named.select("id", F.explode(F.array_union("doclib.key", more)).alias("key"))
    return (
        resets.join(own.hint("merge"), ["id", "key"], "left_semi")
        .groupBy("id")
        .agg(F.collect_list(F.struct("key", "seq", "ts")).alias("resets"))
    )


def reset_flags(documents: DataFrame, messages: DataFrame) -> DataFrame:
    """Apply the reset lists of decoded messages: the named flags collapse to
    their most current entry, stamped with the time of the last message that
    names them.  ``started`` and ``ended`` stay.

    The last resets are aggregated before they are shuffled.  Of the keys that a log
    names for a document only those that the document has are collected, so a row
    stays as long as the document's own flags, whatever the log names.
    """
    asked = resets_per_document(last_resets(messages), documents).select(
        "id", F.expr("map_from_entries(transform(resets, r -> struct(r.key, r.ts)))").alias("__resets")
    )
    stamped = ff.stamp_resets_sql("doclib", lambda key: f"try_element_at(__resets, {key})")
    return (
        documents.join(asked, "id", "left")
        .withColumn("doclib", F.expr(f"CASE WHEN __resets IS NULL THEN doclib ELSE {stamped} END"))
        .drop("__resets")
    )


def reset_changed(messages: DataFrame, documents: DataFrame) -> DataFrame:
    """Per message with a document: does its reset list change anything?"""
    joined = messages.join(documents.select("id", F.col("doclib").alias("__doclib")), "id")
    return joined.withColumn("changed", ff.reset_changed("reset", "__doclib")).drop("__doclib")
