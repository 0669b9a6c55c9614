"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (``lineitem`` through the telemetry
projection, or ``events`` through the event feed) over their whole extent.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import METRICS, WindowSpec
from ..functions.timefmt import normalise_hms
from ..operators.messages import decode_messages, split_wide, topic_counts
from ..sources.feeds import TS_STYLES, event_feed, styled_ts
from ..sources.offsets import offset_ledger
from ..sources.telemetry import load_metrics, read_table, wide_text
from ..config import CPU_MEM_JOB, NET_DISK_JOB
from . import window_reports as wr
from .alert_jobs import cpu_mem_alerts, net_disk_alerts, pair_alerts
from .file_jobs import alerts_via_csv
from ..session import scratch_path
from .incremental import in_batches
from .stream_jobs import consumer_progress, consumer_run, corrected_run, dense_run, topic_alerts, windowed_run
from .ingest_jobs import (
    CONSUMER_1, CONSUMER_2, CONSUMERS, STATUS_COLUMNS, alert_totals, consume, processed_counts,
    progress_snapshot, reject_table,
)

Query = Callable[[SparkSession, str], DataFrame]

DECODE_COLUMNS = ("topic", "metric", "ts_text", "ts", "server_id", "value", "value2", "skipped", "reason")


def q_cpu_mem_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = load_metrics(spark, sf_dir)
    return cpu_mem_alerts(m["cpu"], m["mem"])


def q_net_disk_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = load_metrics(spark, sf_dir)
    return net_disk_alerts(m["net"], m["disk"])


def _pair(spark, sf_dir, job):
    m = load_metrics(spark, sf_dir)
    if job is CPU_MEM_JOB:
        return m["cpu"], m["mem"], job
    return m["net"].drop("net_out"), m["disk"], job


def q_cpu_mem_joined(spark, sf_dir):
    return wr.pairs_table(*_pair(spark, sf_dir, CPU_MEM_JOB))


def q_cpu_mem_joined_split(spark, sf_dir):
    # a small block, so that the given tables hold keys that are split
    return wr.split_pairs_table(*_pair(spark, sf_dir, CPU_MEM_JOB), block=4)


def q_net_disk_joined(spark, sf_dir):
    return wr.pairs_table(*_pair(spark, sf_dir, NET_DISK_JOB))


def q_window_bounds(spark, sf_dir):
    return wr.bounds(*_pair(spark, sf_dir, CPU_MEM_JOB))


def q_window_starts(spark, sf_dir):
    return wr.starts(*_pair(spark, sf_dir, CPU_MEM_JOB))


def q_server_list(spark, sf_dir):
    return wr.servers(*_pair(spark, sf_dir, CPU_MEM_JOB))


def q_window_spine(spark, sf_dir):
    return wr.dense_spine(*_pair(spark, sf_dir, CPU_MEM_JOB))


def q_cpu_mem_windows_nonempty(spark, sf_dir):
    return wr.nonempty_windows(*_pair(spark, sf_dir, CPU_MEM_JOB))


def q_net_disk_windows_nonempty(spark, sf_dir):
    return wr.nonempty_windows(*_pair(spark, sf_dir, NET_DISK_JOB))


HOUR = WindowSpec(length_s=3600, slide_s=10)      # 360 windows hold each sample


def q_cpu_mem_alerts_1h(spark, sf_dir):
    a, b, job = _pair(spark, sf_dir, CPU_MEM_JOB)
    return pair_alerts(a, b, replace(job, window=HOUR))


def q_net_disk_alerts_1h(spark, sf_dir):
    a, b, job = _pair(spark, sf_dir, NET_DISK_JOB)
    return pair_alerts(a, b, replace(job, window=HOUR))


def q_alert_summary(spark, sf_dir):
    return wr.alert_summary({"cpu_mem": q_cpu_mem_alerts(spark, sf_dir),
                             "net_disk": q_net_disk_alerts(spark, sf_dir)})


def q_input_row_counts(spark, sf_dir):
    return wr.row_counts(load_metrics(spark, sf_dir))


def q_cpu_mem_alerts_via_csv(spark, sf_dir):
    return alerts_via_csv(spark, read_table(spark, sf_dir, "lineitem"), CPU_MEM_JOB, "json")


def q_net_disk_alerts_via_csv(spark, sf_dir):
    return alerts_via_csv(spark, read_table(spark, sf_dir, "lineitem"), NET_DISK_JOB, "csv")


# ----------------------------------------------------------------- producer side

def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_text(read_table(spark, sf_dir, "lineitem"))


def q_split_messages_json(spark, sf_dir):
    return split_wide(_wide(spark, sf_dir), "json")


def q_split_messages_csv(spark, sf_dir):
    return split_wide(_wide(spark, sf_dir), "csv")


def q_topic_message_counts(spark, sf_dir):
    return topic_counts(split_wide(_wide(spark, sf_dir), "csv"))


# ----------------------------------------------------------------- consumer side

def q_decode_messages_json(spark, sf_dir):
    return decode_messages(split_wide(_wide(spark, sf_dir), "json"), "json").select(*DECODE_COLUMNS)


def q_decode_messages_csv(spark, sf_dir):
    return decode_messages(split_wide(_wide(spark, sf_dir), "csv"), "csv").select(*DECODE_COLUMNS)


# A subscribed consumer only ever receives its own topics, so only those messages are generated.

def q_cpu_mem_status(spark, sf_dir):
    return consume(split_wide(_wide(spark, sf_dir), "json", CONSUMER_1), CONSUMER_1).select(*STATUS_COLUMNS)


def q_net_disk_status(spark, sf_dir):
    return consume(split_wide(_wide(spark, sf_dir), "json", CONSUMER_2), CONSUMER_2).select(*STATUS_COLUMNS)


def _feed(spark, sf_dir):
    return event_feed(read_table(spark, sf_dir, "events"))


def q_event_feed_decode(spark, sf_dir):
    return consume(_feed(spark, sf_dir), METRICS).select("offset", *STATUS_COLUMNS, "ts_text")


def q_ingest_rejects(spark, sf_dir):
    return reject_table(_feed(spark, sf_dir)).select("topic", "offset", "message", "reason")


def q_processed_counts(spark, sf_dir):
    return processed_counts(consume(_feed(spark, sf_dir), METRICS))


def q_alert_totals(spark, sf_dir):
    return alert_totals(consume(_feed(spark, sf_dir), METRICS))


def q_progress_snapshot(spark, sf_dir):
    return progress_snapshot(consume(_feed(spark, sf_dir), METRICS))


def q_normalise_ts(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    text = styled_ts(F.col("ts"), F.col("event_id") % len(TS_STYLES))
    return ev.select("event_id", text.alias("ts_text")).withColumn("ts_hms", normalise_hms("ts_text"))


# ----------------------------------------------------------------- streaming

def q_stream_cpu_mem_status(spark, sf_dir):
    return consumer_run(spark, read_table(spark, sf_dir, "lineitem"), CONSUMER_1).select(*STATUS_COLUMNS)


def q_stream_cpu_mem_windows(spark, sf_dir):
    return windowed_run(spark, *_pair(spark, sf_dir, CPU_MEM_JOB))


def q_stream_cpu_mem_alerts(spark, sf_dir):
    return windowed_run(spark, *_pair(spark, sf_dir, CPU_MEM_JOB), dense=True)


def q_stream_dense_cpu_mem_alerts(spark, sf_dir):
    return dense_run(spark, *_pair(spark, sf_dir, CPU_MEM_JOB))


def q_stream_dense_net_disk_alerts(spark, sf_dir):
    return dense_run(spark, *_pair(spark, sf_dir, NET_DISK_JOB))


def q_stream_net_disk_status(spark, sf_dir):
    return consumer_run(spark, read_table(spark, sf_dir, "lineitem"), CONSUMER_2, "csv").select(*STATUS_COLUMNS)


def q_stream_net_disk_windows(spark, sf_dir):
    return windowed_run(spark, *_pair(spark, sf_dir, NET_DISK_JOB))


def q_stream_topics_cpu_mem_alerts(spark, sf_dir):
    return topic_alerts(spark, read_table(spark, sf_dir, "lineitem"), CPU_MEM_JOB)


def q_stream_topics_net_disk_alerts(spark, sf_dir):
    return topic_alerts(spark, read_table(spark, sf_dir, "lineitem"), NET_DISK_JOB, "csv")


def q_incremental_cpu_mem_alerts(spark, sf_dir):
    return in_batches(spark, *_pair(spark, sf_dir, CPU_MEM_JOB), scratch_path(spark, "store"))


def q_incremental_net_disk_alerts(spark, sf_dir):
    return in_batches(spark, *_pair(spark, sf_dir, NET_DISK_JOB), scratch_path(spark, "store"))


def q_stream_late_corrected(spark, sf_dir):
    return corrected_run(spark, *_pair(spark, sf_dir, CPU_MEM_JOB))


def q_stream_progress_totals(spark, sf_dir):
    return consumer_progress(spark, read_table(spark, sf_dir, "lineitem"), CONSUMER_1).select("processed", "alerts", "total", "topics_seen", "line")


def q_offset_ledger(spark, sf_dir):
    groups = {name: tuple(m.topic for m in metrics) for name, metrics in CONSUMERS.items()}
    return offset_ledger(spark, split_wide(_wide(spark, sf_dir), "csv"), groups, scratch_path(spark, "topics"), most=1000)


def all_queries() -> dict[str, Query]:
    return {
        "cpu_mem_alerts": q_cpu_mem_alerts,
        "net_disk_alerts": q_net_disk_alerts,
        "cpu_mem_joined": q_cpu_mem_joined,
        "net_disk_joined": q_net_disk_joined,
        "cpu_mem_joined_split": q_cpu_mem_joined_split,
        "window_bounds": q_window_bounds,
        "window_starts": q_window_starts,
        "server_list": q_server_list,
        "window_spine": q_window_spine,
        "cpu_mem_windows_nonempty": q_cpu_mem_windows_nonempty,
        "net_disk_windows_nonempty": q_net_disk_windows_nonempty,
        "cpu_mem_alerts_1h": q_cpu_mem_alerts_1h,
        "net_disk_alerts_1h": q_net_disk_alerts_1h,
        "alert_summary": q_alert_summary,
        "input_row_counts": q_input_row_counts,
        "cpu_mem_alerts_via_csv": q_cpu_mem_alerts_via_csv,
        "net_disk_alerts_via_csv": q_net_disk_alerts_via_csv,
        "split_messages_json": q_split_messages_json,
        "split_messages_csv": q_split_messages_csv,
        "topic_message_counts": q_topic_message_counts,
        "decode_messages_json": q_decode_messages_json,
        "decode_messages_csv": q_decode_messages_csv,
        "cpu_mem_status": q_cpu_mem_status,
        "net_disk_status": q_net_disk_status,
        "event_feed_decode": q_event_feed_decode,
        "ingest_rejects": q_ingest_rejects,
        "processed_counts": q_processed_counts,
        "alert_totals": q_alert_totals,
        "progress_snapshot": q_progress_snapshot,
        "normalise_ts": q_normalise_ts,
        "stream_cpu_mem_status": q_stream_cpu_mem_status,
        "stream_cpu_mem_windows": q_stream_cpu_mem_windows,
        "stream_cpu_mem_alerts": q_stream_cpu_mem_alerts,
        "stream_net_disk_status": q_stream_net_disk_status,
        "stream_net_disk_windows": q_stream_net_disk_windows,
        "stream_topics_cpu_mem_alerts": q_stream_topics_cpu_mem_alerts,
        "stream_topics_net_disk_alerts": q_stream_topics_net_disk_alerts,
        "incremental_cpu_mem_alerts": q_incremental_cpu_mem_alerts,
        "incremental_net_disk_alerts": q_incremental_net_disk_alerts,
        "stream_late_corrected": q_stream_late_corrected,
        "stream_dense_cpu_mem_alerts": q_stream_dense_cpu_mem_alerts,
        "stream_dense_net_disk_alerts": q_stream_dense_net_disk_alerts,
        "stream_progress_totals": q_stream_progress_totals,
        "offset_ledger": q_offset_ledger,
    }
