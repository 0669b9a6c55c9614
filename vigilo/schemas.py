"""Declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from .config import WIDE_COLUMNS

# Wide producer input: every field is text, as read from a CSV header row.
WIDE_TEXT = T.StructType([T.StructField(c, T.StringType(), True) for c in WIDE_COLUMNS])

# Kafka-shaped message rows (same names as Spark's Kafka source, value as text).
MESSAGES = T.StructType([
    T.StructField("topic", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])


def metric_table(*value_columns: str) -> T.StructType:
    """Typed metric table: ``ts timestamp, server_id string, <values> float``."""
    fields = [
        T.StructField("ts", T.TimestampType(), True),
        T.StructField("server_id", T.StringType(), True),
    ]
    fields += [T.StructField(c, T.FloatType(), True) for c in value_columns]
    return T.StructType(fields)


CPU_TABLE = metric_table("cpu_pct")
MEM_TABLE = metric_table("mem_pct")
NET_TABLE = metric_table("net_in", "net_out")
DISK_TABLE = metric_table("disk_io")

TYPED_WIDE = metric_table("cpu_pct", "mem_pct", "net_in", "net_out", "disk_io")


def result_schema(first: str, second: str, how: str) -> T.StructType:
    """Alert result table: ``server_id, window_start, window_end, <first>, <second>, alert``."""
    num = T.DoubleType() if how == "avg" else T.FloatType()
    return T.StructType([
        T.StructField("server_id", T.StringType(), True),
        T.StructField("window_start", T.StringType(), True),
        T.StructField("window_end", T.StringType(), True),
        T.StructField(first, num, True),
        T.StructField(second, num, True),
        T.StructField("alert", T.StringType(), True),
    ])
