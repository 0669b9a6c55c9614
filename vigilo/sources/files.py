"""File scans and sinks: metric CSVs, the wide producer CSV, results, message files.

All reads declare their schema; all writes are ordinary fault-tolerant Spark
writes of a directory of part files (no single-task funnel).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import MetricSpec
from ..functions.metrics import double_text
from ..functions.timefmt import parse_ts_text
from ..schemas import MESSAGES, WIDE_TEXT
from ..session import write_folders


def metric_csv_schema(metric: MetricSpec) -> T.StructType:
    """Positional schema of a per-topic CSV: ``ts, server_id, <value>[, net_out], event_ts``; values are floats."""
    values = (metric.column, *metric.extra_columns)
    return T.StructType([T.StructField(n, T.FloatType() if n in values else T.StringType(), True)
                         for n in ("ts", "server_id", *values, "event_ts")])


def read_metric_csv(spark: SparkSession, path: str, metric: MetricSpec,
                    base_date: str | None = None) -> DataFrame:
    """Scan a per-topic metric CSV (header row, columns by position) into a typed table.

    ``ts`` is the full timestamp: the ``event_ts`` column when the file has one,
    else the ``ts`` text when it carries a date, else ``base_date`` + the bare
    time (NULL without ``base_date``: a bare time never takes today's date).
    Values are the CSV reader's floats; what it can't read (``nan`` and ``inf`` too) is NULL.
    """
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
           .schema(metric_csv_schema(metric)).csv(path))
    ts = F.coalesce(F.try_to_timestamp("event_ts"), parse_ts_text("ts", base_date))
    return raw.select(ts.alias("ts"), F.col("server_id"), metric.column, *metric.extra_columns)


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """Scan the producer's wide CSV: header row, seven text columns.

    Empty cells (and cells that a short line lacks) are empty text, doubled quotes inside quotes are one
    quote. Lines end at line breaks, also inside quotes, so that large files are split.
    """
    raw = spark.read.option("header", True).option("escape", '"').schema(WIDE_TEXT).csv(path)
    return raw.select(*[F.coalesce(c, F.lit("")).alias(c) for c in raw.columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a header CSV directory. A globally sorted frame keeps its order across part files."""
    df.write.mode(mode).option("header", True).csv(path)


def append_metric_csv(typed: DataFrame, path: str) -> None:
    """Append typed rows to a per-topic CSV directory (the consumers' append), numbers as Python prints them."""
    text = [double_text(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in typed.schema]
    write_csv(typed.select(*text), path, mode="append")


def write_result(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a result table (header CSV by default) as a directory, overwriting."""
    if fmt == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan a result CSV directory written by ``write_result``."""
    return spark.read.option("header", True).schema(schema).csv(path)


def publish_messages(messages: DataFrame, path: str, mode: str = "append") -> None:
    """File stand-in for publishing to topics: parquet partitioned by topic."""
    write_folders(messages.select("topic", "value", *[c for c in ("offset", "timestamp") if c in messages.columns]), path, ("topic",), mode)


def read_messages(spark: SparkSession, path: str, topics: list[str] | None = None) -> DataFrame:
    """Batch read of published message files (topic pruning via the partition column)."""
    df = spark.read.parquet(path)
    if topics:
        df = df.where(F.col("topic").isin(*topics))
    for f in MESSAGES.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.select(*[f.name for f in MESSAGES.fields])
