"""What handling messages gives, whichever plan works it out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.schema import SENDS_TYPE
from docroute.sources.documents import Work
from docroute.sources.sinks import dead_letters, outgoing

RESULT_COLUMNS = ["seq", "ts", "id", "status", "rule", "stage_key", "sends", "reason"]


def status(reason: Column, stage_key: Column, sends: Column) -> Column:
    """What became of a message: the reason it failed, ``no_match``, ``held``
    (a stage matched, but there is nothing to send) or ``sent``."""
    return (
        F.when(reason.isNotNull(), reason)
        .when(stage_key.isNull(), F.lit("no_match"))
        .when(F.size(sends) > 0, F.lit("sent"))
        .otherwise(F.lit("held"))
    )


def failed_results(messages: DataFrame) -> DataFrame:
    """Result rows for messages that carry a ``reason``."""
    none = F.lit(None).cast("string")
    return messages.select(
        "seq",
        "ts",
        "id",
        F.col("reason").alias("status"),
        none.alias("rule"),
        none.alias("stage_key"),
        F.array().cast(SENDS_TYPE).alias("sends"),
        "reason",
    )


@dataclass
class SupervisedLog:
    """``results`` has a row per message, ``documents`` the new flags (id, doclib)
    of every document that was named.  ``sends`` and ``dead_letters`` follow from
    the results.  ``work`` holds the intermediate tables; remove it after use."""

    results: DataFrame
    documents: DataFrame
    work: Work

    @property
    def sends(self) -> DataFrame:
        """One row (route, body) per message and queue."""
        return outgoing(self.results)

    @property
    def dead_letters(self) -> DataFrame:
        """Every message that failed, with its reason."""
        return dead_letters(self.results)
