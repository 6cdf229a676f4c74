"""Document snapshots: reading, writing flags, and tables in the shared folder.

A store is a folder with versions of its documents.  The documents are in buckets of
the id, sorted by it, and a version is a small table that names the folder of each
bucket: a write adds the buckets that it changes and then a version, which shares
the other buckets with the one before.  A version counts from the moment it is
complete, so a reader sees all of a write or nothing of it, also where it breaks off.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docroute.functions.flags import quote
from docroute.schema import DOCUMENT_SCHEMA

#: Documents in a bucket of a new store, about, and how many buckets it has at least.
BUCKET_DOCUMENTS, LEAST_BUCKETS = 250_000, 8
#: Bytes of a row group: the least that is read for one document.
ROW_GROUP_BYTES = 8 << 20
#: Up to this many ids are looked up one by one; for more, their buckets are read.
LOOKUP_IDS = 10_000
#: Tasks of a write at most.
WRITE_TASKS = 4096

VERSION = "bucket int, folder string, buckets int"


def bucket_of(id_column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id_column), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Version:
    """What a store holds by its ``number``-th write: the folder of each bucket, by
    which a store of a million documents has four and one of 10^10 has 40,000."""

    number: int
    buckets: int
    folders: dict[int, str]


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The newest complete version of a store; None if the path is no store."""
    numbers = [int(name) for name in folders(spark, f"{path}/versions")]
    for number in sorted(numbers, reverse=True):
        folder = f"{path}/versions/{number}"
        if exists(spark, f"{folder}/_SUCCESS"):
            rows = spark.read.schema(VERSION).json(folder).collect()
            return Version(number, rows[0].buckets, {r.bucket: r.folder for r in rows if r.folder})
    return None


def _read_buckets(spark: SparkSession, path: str, version: Version, wanted: Iterable[int] | None, schema: T.StructType) -> DataFrame:
    some = version.folders if wanted is None else sorted(set(wanted) & set(version.folders))
    paths = [f"{path}/{version.folders[bucket]}" for bucket in some]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_documents(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT_SCHEMA) -> DataFrame:
    """The documents of a store, or of a folder of Parquet files."""
    version = current_version(spark, path)
    if version is None:
        return spark.read.schema(schema).parquet(path)
    return _read_buckets(spark, path, version, None, schema)


def few_ids(ids: DataFrame, most: int = LOOKUP_IDS) -> list[str] | None:
    """The distinct ids, or None if there are more than can be looked up."""
    found = [r.id for r in ids.select("id").limit(most + 1).collect()]
    return found if len(found) <= most else None


def id_in(ids: list[str]) -> Column:
    return F.expr(f"id IN ({', '.join(map(quote, ids))})") if ids else F.lit(False)


def read_named(spark: SparkSession, path: str, ids: DataFrame, named: list[str] | None, schema: T.StructType = DOCUMENT_SCHEMA) -> DataFrame:
    """The documents with these ids, given also as a list if they are few
    (``few_ids``).  That costs as much as these documents: of their buckets, the row
    groups whose range and bloom filter of ids admit one.  Of more ids, the documents
    of their buckets are joined with them."""
    version = current_version(spark, path)
    if version is None:
        documents = spark.read.schema(schema).parquet(path)
    else:
        own = ids if named is None else spark.createDataFrame([(i,) for i in named], "id string")
        wanted = own.select(bucket_of("id", version.buckets).alias("b")).distinct()
        # At most as many numbers as there are buckets.
        documents = _read_buckets(spark, path, version, [r.b for r in wanted.collect()], schema)
    if named is None:
        return documents.join(ids.select("id"), "id", "left_semi")
    return documents.filter(id_in(named))


def update_documents(documents: DataFrame, changed: DataFrame) -> DataFrame:
    """The documents with the flags of ``changed`` (id, doclib) in place of
    their own.  One join on the id, and a broadcast if few changed."""
    new = changed.select("id", F.col("doclib").alias("__doclib"), F.lit(True).alias("__changed"))
    return documents.join(new, "id", "left").select(
        *[
            F.when(F.col("__changed"), F.col("__doclib")).otherwise(F.col("doclib")).alias("doclib")
            if name == "doclib"
            else F.col(name)
            for name in documents.columns
        ]
    )


def _write_buckets(rows: DataFrame, folder: str, buckets: int, tasks: int) -> None:
    """One sorted file per bucket."""
    dealt = rows.withColumn("bucket", bucket_of("id", buckets)).repartition(min(tasks, WRITE_TASKS), "bucket")
    (
        dealt.sortWithinPartitions("bucket", "id")
        .write.option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.bloom.filter.enabled#id", "true")
        .partitionBy("bucket")
        .parquet(folder)
    )


def write_flags(documents: DataFrame, changed: DataFrame, path: str, buckets: int | None = None) -> DataFrame:
    """Write the documents with the changed flags to the store at ``path``.

    A new store gets all documents, in ``buckets`` buckets (by default one for every
    ``BUCKET_DOCUMENTS``).  In one that exists, only the buckets with a change are
    written anew, from the store's own documents; no file of an earlier version is
    touched, so whoever reads one can go on.
    """
    spark, schema = documents.sparkSession, documents.schema
    version = current_version(spark, path)
    written = f"data/{uuid.uuid4().hex}"
    if version is None:
        if buckets is None:
            buckets = max(LEAST_BUCKETS, -(-documents.count() // BUCKET_DOCUMENTS))
        number, kept, tasks = 1, {}, buckets
        rows = update_documents(documents, changed)
    else:
        work = Work(spark)
        number, buckets, kept = version.number + 1, version.buckets, version.folders
        changed = work.table(changed.select("id", "doclib"))
        # At most as many numbers as there are buckets.
        touched = [r.b for r in changed.select(bucket_of("id", buckets).alias("b")).distinct().collect()]
        tasks = max(1, len(touched))
        rows = update_documents(_read_buckets(spark, path, version, touched, schema), changed)
    _write_buckets(rows, f"{path}/{written}", buckets, tasks)
    new = {int(name.split("=")[1]): f"{written}/{name}" for name in folders(spark, f"{path}/{written}") if "=" in name}
    if version is not None:
        work.remove()
    # A store without documents has one row, without a folder.
    now = [(b, f, buckets) for b, f in sorted({**kept, **new}.items())] or [(None, None, buckets)]
    spark.createDataFrame(now, VERSION).coalesce(1).write.json(f"{path}/versions/{number}")
    return _read_buckets(spark, path, Version(number, buckets, {**kept, **new}), None, schema)


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` complete versions, those that never became
    complete before them, and the files that only they hold."""
    complete = [
        n for n in sorted(int(name) for name in folders(spark, f"{path}/versions")) if exists(spark, f"{path}/versions/{n}/_SUCCESS")
    ]
    if len(complete) <= keep:
        return
    kept = [spark.read.schema(VERSION).json(f"{path}/versions/{n}").select("folder") for n in complete[-keep:]]
    used = {r.folder for r in reduce(DataFrame.union, kept).distinct().collect()}
    for name in folders(spark, f"{path}/versions"):
        if int(name) < complete[-keep]:
            old = f"{path}/versions/{name}"
            for r in spark.read.schema(VERSION).json(old).collect():
                if r.folder and r.folder not in used:
                    remove(spark, f"{path}/{r.folder}")
            remove(spark, old)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as named by ``spark.checkpoint.dir``
    or set on the context."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _file_system(spark, path)
    return files.exists(place)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in ``path``, none if there is no such path."""
    place, files = _file_system(spark, path)
    if not files.exists(place):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(place) if f.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.delete(place, True)


class Work:
    """Intermediate tables of one run, in a folder of their own, to be removed
    together when the run's results have been used."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/docroute-{uuid.uuid4().hex}"
        self.n = 0

    def table(self, df: DataFrame, *partition_by: str) -> DataFrame:
        self.n += 1
        path = f"{self.path}/{self.n}"
        df.write.partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def remove(self) -> None:
        remove(self.spark, self.path)
