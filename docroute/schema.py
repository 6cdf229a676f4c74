"""Row types of the routing engine.

A document is one nested record: a mimetype plus the history of processing
flags in ``doclib``.  A message names one document and, optionally, the flags
that have to be processed again.
"""

from pyspark.sql import types as T

VERSION_TYPE = T.StructType(
    [
        T.StructField("number", T.StringType()),
        T.StructField("major", T.IntegerType()),
        T.StructField("minor", T.IntegerType()),
        T.StructField("patch", T.IntegerType()),
        T.StructField("hash", T.StringType()),
    ]
)

FLAG_TYPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("version", VERSION_TYPE),
        T.StructField("started", T.TimestampNTZType()),
        T.StructField("ended", T.TimestampNTZType()),
        T.StructField("reset", T.TimestampNTZType()),
        T.StructField("queued", T.BooleanType()),
    ]
)

FLAGS_TYPE = T.ArrayType(FLAG_TYPE)

ATTRS_TYPE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("mtime", T.TimestampNTZType()),
        T.StructField("ctime", T.TimestampNTZType()),
        T.StructField("atime", T.TimestampNTZType()),
        T.StructField("size", T.LongType()),
    ]
)

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("hash", T.StringType()),
        T.StructField("derivative", T.BooleanType()),
        T.StructField("created", T.TimestampNTZType()),
        T.StructField("updated", T.TimestampNTZType()),
        T.StructField("mimetype", T.StringType()),
        T.StructField("doclib", FLAGS_TYPE),
        T.StructField("attrs", ATTRS_TYPE),
    ]
)

# seq is the arrival number of a message and unique in its log.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("body", T.StringType()),
    ]
)

REQUIRED_SCHEMA = T.StructType(
    [
        T.StructField("stage_key", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("flag", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("type", T.StringType()),
    ]
)

SEND_TYPE = T.StructType(
    [
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("flag", T.StringType()),
        T.StructField("route", T.StringType()),
    ]
)

SENDS_TYPE = T.ArrayType(SEND_TYPE)

# NULL: no rule matched.  An empty `sends` is a match that has nothing to send.
RESOLUTION_TYPE = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("stage_key", T.StringType()),
        T.StructField("sends", SENDS_TYPE),
        T.StructField("error", T.StringType()),
    ]
)
