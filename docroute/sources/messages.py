"""Messages: intake, strict decoding, and the two joins with the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.functions import messages as fm
from docroute.schema import MESSAGE_SCHEMA


def read_messages(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    format: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Messages (seq, ts, body) from files, as a batch or as a stream.

    Any other source with these three columns serves as well, e.g. a topic
    whose offset is ``seq``, timestamp ``ts`` and value ``body``.
    """
    if not stream:
        return spark.read.format(format).schema(MESSAGE_SCHEMA).load(path)
    reader = spark.readStream.format(format).schema(MESSAGE_SCHEMA)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def deal_out(rows: DataFrame) -> DataFrame:
    """The rows in as many partitions as there are cores, or splits.  Few files are few
    tasks, however much is to be worked out for a row: of a file's splits only those
    that a row group begins in have rows."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, rows.rdd.getNumPartitions()))


def decode_messages(messages: DataFrame) -> DataFrame:
    """Decode ``body`` into ``id`` and ``reset``.

    ``ok`` says whether the body is a message: one JSON object with a string
    ``id`` and, if present, a ``reset`` that is null or a list of strings.
    ``reason`` names what is wrong, also for an id that is not 24 hex digits.
    Ids come out in lower case.
    """
    # The fields pass through a one-row generator.  Filters on them stay above
    # it; pushed below, they would parse every body again for each reference.
    given = [F.col(f"`{name}`") for name in messages.columns]
    decoded = (
        messages.select(*given, F.expr(fm.parse_sql("body")).alias("__listed"))
        .select(*given, F.expr(fm.parts_sql("__listed", "body")).alias("__parts"))
        .select(*given, F.expr(fm.typed_sql("__parts")).alias("__typed"))
        .select(*given, F.explode(F.array(F.expr(fm.fields_sql("__typed")))).alias("__fields"))
    )
    return decoded.select(*given, "__fields.id", "__fields.reset", "__fields.ok", "__fields.reason")


def lookup_documents(messages: DataFrame, documents: DataFrame) -> DataFrame:
    """Decoded messages with their documents.  A document that most messages
    name is a skewed key; adaptive execution splits it."""
    return messages.join(documents, "id")


def missing_documents(messages: DataFrame, documents: DataFrame) -> DataFrame:
    """Decoded messages whose document does not exist."""
    return messages.join(documents.select("id"), "id", "left_anti")
