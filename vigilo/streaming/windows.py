"""Windowed alerts on live metric streams (watermarked, each window emitted once).

Two metric streams are tagged and unioned, and each micro-batch is reduced to the statistics of its
``(ts, server_id)`` keys (per-key n / count / sum / max per side, the same weighted form as batch).
Keys wait in files (``streaming.state``) until the watermark passes the end of their windows; then
the windows are computed by the batch job's steps and emitted, and their keys are dropped, so the
state stays bounded by the watermark delay, on disk and not in the executors' memory.

A stream cannot know the global first/last timestamp, so it emits non-empty
windows only (including windows that begin before the first aligned start);
the dense, trimmed table is a batch read of the sink passed through
``plans.alert_jobs.finish``. Both feeds carry the watermark (the global
watermark is the slower feed's).

End of stream: a finite source (files, ``availableNow``) leaves the newest
windows in state. Appending heartbeat rows per feed with server id
``HEARTBEAT_SERVER`` and timestamps past the last window pushes the watermark
on; ``read_windowed`` drops that server. (Rows without a server id never advance
event time.)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import MetricSpec, PairJobSpec
from ..operators.messages import accepted, decode_messages, typed_table
from ..operators.pairing import both_sides
from ..plans.alert_jobs import load_rounded
from ..sources.commits import CommittedTable, _Files
from .state import WindowState, delay_us

HEARTBEAT_SERVER = "__heartbeat__"


def start_final_windows(a: DataFrame, b: DataFrame, job: PairJobSpec, checkpoint: str, watermark: str,
                        emit: Callable[[DataFrame, int, str], None], available_now: bool = False,
                        processing_time: str | None = None) -> StreamingQuery:
    """A stream that gives ``emit(windows, batch_id, run)`` each batch's final windows: ``server_id, w, x_a, x_b, _lo``.

    ``w`` is the window start index (start = w * slide seconds), as in batch. ``emit`` commits them under the batch's id and the
    run's (the checkpoint's): a batch repeated after a failure replaces itself. The state lies below the checkpoint.
    """
    job.window.validate()
    spark, fa, fb = a.sparkSession, job.first.column, job.second.column
    delay = delay_us(spark, watermark)
    if _Files(spark, checkpoint).names("state"):
        raise ValueError(f"{checkpoint} has state of Spark's own operators, of an earlier version; start from a new checkpoint")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        window_state(session, checkpoint, job, delay).take(batch, batch_id, lambda windows: emit(windows, batch_id, run))

    w = (both_sides(load_rounded(a, fa), fa, load_rounded(b, fb), fb).writeStream
         .foreachBatch(write).option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def window_state(spark: SparkSession, checkpoint: str, job: PairJobSpec, delay: int = 0) -> WindowState:
    """The state of the stream with a checkpoint."""
    return WindowState(spark, f"{checkpoint}/windows", job, delay)


def late_rows(spark: SparkSession, checkpoint: str, job: PairJobSpec) -> int:
    """Rows that came later than the watermark allows and were dropped, since the checkpoint began."""
    return window_state(spark, checkpoint, job).late_rows()


def windowed_table(spark: SparkSession, out_dir: str) -> CommittedTable:
    """The final windows of all streams that write to a path."""
    return CommittedTable(spark, out_dir)


def start_windowed_alerts(a: DataFrame, b: DataFrame, job: PairJobSpec, out_dir: str, checkpoint: str,
                          watermark: str = "60 seconds", available_now: bool = False,
                          processing_time: str | None = None,
                          state_partitions: int | None = None) -> StreamingQuery:
    """Append finalised windows to a committed table (exactly once); ``read_windowed`` reads it.

    ``state_partitions``: number of tasks that a batch's keys and windows are
    dealt to. A checkpoint fixes it at its first start; by default it is the
    session's ``spark.sql.shuffle.partitions``. Only the start of this query
    sees the value; the session setting is restored afterwards.
    """
    def start() -> StreamingQuery:
        return start_final_windows(
            a, b, job, checkpoint, watermark,
            lambda windows, batch, run: windowed_table(windows.sparkSession, out_dir).commit(windows, batch, run),
            available_now, processing_time)

    if not state_partitions:
        return start()
    spark = a.sparkSession
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(int(state_partitions)))
    try:
        return start()
    finally:
        spark.conf.set(key, before)


def read_windowed(spark: SparkSession, out_dir: str) -> DataFrame:
    """Batch view of the finalised windows (heartbeat windows removed)."""
    return windowed_table(spark, out_dir).read().where(F.col("server_id") != F.lit(HEARTBEAT_SERVER))


def metric_stream(messages: DataFrame, metric: MetricSpec, fmt: str = "json", base_date: str | None = None) -> DataFrame:
    """A topic stream's accepted messages of one metric as a typed feed: ``ts`` (full time), ``server_id``, the value."""
    typed = typed_table(accepted(decode_messages(messages, fmt, (metric,), base_date)), metric)
    return typed.select(F.col("event_ts").alias("ts"), "server_id", F.col(metric.column).cast("float").alias(metric.column))


def start_topic_alerts(messages: DataFrame, job: PairJobSpec, out_dir: str, checkpoint: str, fmt: str = "json",
                       base_date: str | None = None, **options) -> StreamingQuery:
    """Live windowed alerts straight from a stream of topic messages; options as ``start_windowed_alerts``."""
    a, b = (metric_stream(messages, m, fmt, base_date) for m in (job.first, job.second))
    return start_windowed_alerts(a, b, job, out_dir, checkpoint, **options)
