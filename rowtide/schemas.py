"""Fixed schemas: the change envelope, the flat change row, the ledger."""

from __future__ import annotations

from pyspark.sql import types as T

ROW_IMAGE = T.MapType(T.StringType(), T.StringType())

SOURCE_BLOCK = T.StructType(
    [
        T.StructField("connector", T.StringType()),
        T.StructField("db", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("snapshot", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("server_id", T.LongType()),
    ]
)

PAYLOAD = T.StructType(
    [
        T.StructField("before", ROW_IMAGE),
        T.StructField("after", ROW_IMAGE),
        T.StructField("source", SOURCE_BLOCK),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)

CORRUPT_COLUMN = "_corrupt_record"

# One parse schema for both shapes: wrapped, and bare (converter schemas
# off, the payload fields at top level), plus the corrupt-record column.
PARSE_SCHEMA = T.StructType(
    [T.StructField("payload", PAYLOAD)]
    + list(PAYLOAD.fields)
    + [T.StructField(CORRUPT_COLUMN, T.StringType())]
)

VALID_OPS = ("c", "u", "d", "r")
UPSERT_OPS = ("c", "u", "r")
DELETE_OP = "d"

LEDGER = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("completed_at", T.TimestampNTZType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)

WRITE_RESULT = T.StructType(
    [
        T.StructField("sink", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("upserted", T.LongType()),
        T.StructField("deleted", T.LongType()),
        T.StructField("errors", T.ArrayType(T.StringType())),
    ]
)
