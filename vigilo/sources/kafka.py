"""Kafka adapters (need Spark's Kafka connector on the classpath; not exercised in tests).

The shapes match the file stand-ins in ``files.py`` and the streaming module:
messages are ``topic, value (text), offset, timestamp``. Resume position is
the streaming checkpoint, which replaces a consumer group's committed offsets.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


OFFSETS_PER_TRIGGER = 50_000_000     # bounds a micro-batch, the first one over a backlog too


def _shape(df: DataFrame) -> DataFrame:
    return df.select("topic", F.col("value").cast("string").alias("value"), "offset", "timestamp")


def read_topics(spark: SparkSession, bootstrap: str, topics: Iterable[str], stream: bool = True,
                starting: str = "earliest", options: dict | None = None) -> DataFrame:
    """Subscribe to several topics from ``starting`` offsets (streaming by default).

    Lost offsets fail the query, Spark's default, and a stream's trigger takes OFFSETS_PER_TRIGGER messages at most;
    ``options`` may say otherwise.
    """
    reader = spark.readStream if stream else spark.read
    r = (reader.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", ",".join(topics))
         .option("startingOffsets", starting))
    bound = {"maxOffsetsPerTrigger": OFFSETS_PER_TRIGGER} if stream else {}
    for k, v in {**bound, **(options or {})}.items():
        r = r.option(k, v)
    return _shape(r.load())


def publish(messages: DataFrame, bootstrap: str) -> None:
    """Publish ``topic, value`` rows, each to its own topic (batch)."""
    (messages.select("topic", F.col("value").cast("string").alias("value"))
     .write.format("kafka").option("kafka.bootstrap.servers", bootstrap).save())
