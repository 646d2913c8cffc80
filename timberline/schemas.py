"""Explicit schemas of every file and table the library reads or writes; nothing is inferred."""

from pyspark.sql import types as T

STRUCTURED_CSV = T.StructType(
    [
        T.StructField("LineId", T.StringType()),
        T.StructField("Content", T.StringType()),
        T.StructField("EventId", T.StringType()),
        T.StructField("EventTemplate", T.StringType()),
    ]
)

TEMPLATES_CSV = T.StructType(
    [
        T.StructField("EventId", T.StringType()),
        T.StructField("EventTemplate", T.StringType()),
        T.StructField("Occurrences", T.StringType()),
    ]
)

LOG_ENTRIES = T.StructType(
    [
        T.StructField("line_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("log_timestamp", T.TimestampNTZType()),
        T.StructField("month", T.StringType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("time_text", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("process_id", T.IntegerType()),
        T.StructField("level", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("raw_message", T.StringType()),
        T.StructField("normalized_message", T.StringType()),
        T.StructField("event_template", T.StringType()),
    ]
)

EVENT_TEMPLATES = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_template", T.StringType()),
        T.StructField("occurrences", T.IntegerType()),
    ]
)

MESSAGE_VECTORS = T.StructType(
    [
        T.StructField("normalized_message", T.StringType()),
        T.StructField("representative_event_id", T.StringType()),
        T.StructField("representative_level", T.StringType()),
        T.StructField("occurrences", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

MESSAGE_SUMMARIES = T.StructType(
    [
        T.StructField("normalized_message", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("template", T.StringType()),
        T.StructField("lines", T.LongType()),
        T.StructField("first_log", T.TimestampNTZType()),
        T.StructField("last_log", T.TimestampNTZType()),
    ]
)

HOUR_SUMMARIES = T.StructType(
    [
        T.StructField("bucket", T.TimestampNTZType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("lines", T.LongType()),
        T.StructField("message_sketch", T.BinaryType()),
        T.StructField("host_sketch", T.BinaryType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("command", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("details", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("finished_at", T.TimestampNTZType()),
    ]
)

REQUESTS = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("top_k", T.IntegerType()),
    ]
)
