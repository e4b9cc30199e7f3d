"""Schemas of the engine's tables."""

from pyspark.sql import types as T

HEADERS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))

#: One row of a partitioned log. Headers are an ordered list in which keys may repeat; null and empty payloads differ.
ENVELOPE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp_ms", T.LongType()),
    T.StructField("timestamp_type", T.StringType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("headers", HEADERS),
])

LOG = ["topic", "partition"]
#: The names of timestamp types, by the number a log source gives them.
TIMESTAMP_TYPES = {0: "create_time", 1: "log_append_time", -1: "not_available"}
#: File endings of the two segment formats.
ENDINGS = {"parquet": "parquet", "ndjson": "ndjson"}
