"""Sinks: queues and dead letters, as folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.functions.messages import render_body


def outgoing(handled: DataFrame) -> DataFrame:
    """One row (route, body) per document and queue, from ``id`` and ``sends``."""
    # The outer form, because the inner one makes Spark test for empty sends
    # first and so work them out twice.
    routes = handled.select("id", F.explode_outer("sends.route").alias("route"))
    return routes.filter("route IS NOT NULL").select("route", render_body(F.col("id")).alias("body"))


def publish(handled: DataFrame, path: str) -> None:
    """Write every queue's messages to its own folder ``route=<queue>``, a JSON
    text per line.

    Overwrites ``path``, so that a repeated batch replaces its own output.
    Rows are not shuffled: a busy queue stays spread over the tasks.
    """
    outgoing(handled).write.mode("overwrite").partitionBy("route").text(path)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """What ``publish`` wrote: (route, body)."""
    return spark.read.schema("value string, route string").text(path).select("route", F.col("value").alias("body"))


def dead_letters(results: DataFrame) -> DataFrame:
    """The failed messages with their reason."""
    return results.filter(F.col("reason").isNotNull()).select("seq", "ts", "id", "reason")
