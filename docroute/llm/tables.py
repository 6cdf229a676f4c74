"""Tables that an operator makes on its way: where they lie, and when they go.

All lie in the folder that the cluster shares, so that a lost executor costs no
more than the table at hand.  An operator that is ``finished`` writes its result,
removes what it made on the way and takes back its settings.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from docroute.llm.text import ARROW_BYTES, BATCH_BYTES, BATCH_ROWS
from docroute.sources.documents import remove, shared_folder

#: The folders that the operator at work has made.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/docroute-{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there: worked
    out once, safe from lost executors, and of known size."""
    path = new_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _settings(spark: SparkSession) -> dict[str, str]:
    """What holds while an operator runs.  The number of splits would follow the
    number of cores, but passes over a table must see the same splits, also when
    executors come or go in between.  Rows with texts or sets are kilobytes each, so
    few are read or sent at a time."""
    splits = "spark.sql.files.minPartitionNum"
    cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    read = "spark.sql.parquet.columnarReaderBatchSize"
    short = int(spark.conf.get(rows))
    return {
        splits: spark.conf.get(splits, None) or str(cores),
        rows: str(min(short, BATCH_ROWS) if short > 0 else BATCH_ROWS),
        ARROW_BYTES: spark.conf.get(ARROW_BYTES, None) or str(BATCH_BYTES),
        read: spark.conf.get(read, None) or str(BATCH_ROWS),
    }


def finished(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Have an operator's result written and all else that it made removed."""

    @functools.wraps(make)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        spark = docs.sparkSession
        path = new_folder(spark, make.__name__.strip("_"))
        settings = _settings(spark)
        before = {key: spark.conf.get(key, None) for key in settings}
        made: list[str] = []
        token = _made.set(made)
        try:
            for key, value in settings.items():
                spark.conf.set(key, value)
            result = make(docs, *args, **kwargs)
            result.write.parquet(path)
        finally:
            _made.reset(token)
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)
            for folder in made:
                remove(spark, folder)
        return spark.read.schema(result.schema).parquet(path)

    return run
