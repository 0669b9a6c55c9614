"""Ingest-side plans: producer split, consumer decode, status, rejects, tallies."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CONSUMER_GROUP_CPU_MEM, CONSUMER_GROUP_NET_DISK, CPU, DISK, MEM, NET, MetricSpec
from ..operators.messages import accepted, decode_messages, rejects, with_status

CONSUMER_1 = (CPU, MEM)     # consumer group for topic-cpu + topic-mem
CONSUMER_2 = (NET, DISK)    # consumer group for topic-net + topic-disk
CONSUMERS = {CONSUMER_GROUP_CPU_MEM: CONSUMER_1, CONSUMER_GROUP_NET_DISK: CONSUMER_2}

STATUS_COLUMNS = ("topic", "metric", "ts", "server_id", "value", "value2", "is_alert", "status", "line")


def consume(messages: DataFrame, metrics: Iterable[MetricSpec], fmt: str = "json",
            base_date: str | None = None) -> DataFrame:
    """One consumer's accepted messages with per-message status."""
    return with_status(accepted(decode_messages(messages, fmt, metrics, base_date)), metrics)


def consumer_tag(topic_col: str = "topic"):
    expr = None
    for name, ms in CONSUMERS.items():
        cond = F.col(topic_col).isin(*[m.topic for m in ms])
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def processed_counts(parsed: DataFrame) -> DataFrame:
    """Accepted messages per topic (what the consumers count and cache)."""
    return parsed.groupBy("topic").agg(F.count(F.lit(1)).alias("processed"))


def alert_totals(statused: DataFrame) -> DataFrame:
    """Alerts raised per consumer group."""
    return (statused.groupBy(consumer_tag().alias("consumer"))
            .agg(F.count_if("is_alert").alias("alerts")))


def progress_snapshot(parsed: DataFrame) -> DataFrame:
    """Per consumer group: messages processed, topics seen, average per topic seen."""
    g = parsed.groupBy(consumer_tag().alias("consumer")).agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_distinct("topic").alias("topics_seen"))
    return g.withColumn("avg_per_topic",
                        F.round(F.col("total_processed") / F.greatest(F.col("topics_seen"), F.lit(1)), 2))


def reject_table(messages: DataFrame, fmt: str = "json", metrics: Iterable[MetricSpec] = (CPU, MEM, NET, DISK)
                 ) -> DataFrame:
    return rejects(decode_messages(messages, fmt, metrics))
