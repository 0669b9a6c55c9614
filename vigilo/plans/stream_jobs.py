"""Streaming runs over staged files (the Kafka stand-in), read back as batch tables.

Each run stages its input under the shared folder, runs the stream to the end
of the available input (``availableNow``), and returns a lazy read of the sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import MetricSpec, PairJobSpec
from ..operators.messages import split_wide
from ..session import scratch_path
from ..sources.files import publish_messages
from ..sources.telemetry import wide_text
from ..streaming.consumer import message_file_stream, progress_totals, read_consumer_output, read_metric_table, start_consumer
from ..streaming.dense import DenseSink, start_dense_alerts
from ..streaming.windows import HEARTBEAT_SERVER, late_rows, read_windowed, start_windowed_alerts
from .alert_jobs import finish, pair_alerts
from .incremental import AlertStore, start_corrected_alerts

HEARTBEATS = 3
SLICE_SECONDS = 60           # a feed arrives in slices of so much event time
FILES_PER_TRIGGER = 64       # of each feed


class LateRows(RuntimeError):
    """The watermark dropped rows: the windows are not complete."""


def _consume(spark: SparkSession, lineitem: DataFrame, metrics: tuple[MetricSpec, ...], fmt: str) -> str:
    """Producer → published message files → consumer stream; the output folder."""
    work = scratch_path(spark, "consumer-stream")
    publish_messages(split_wide(wide_text(lineitem), fmt, metrics), f"{work}/topics")
    q = start_consumer(message_file_stream(spark, f"{work}/topics"), f"{work}/out", f"{work}/checkpoint", metrics, fmt,
                       available_now=True)
    q.awaitTermination()
    return f"{work}/out"


def consumer_run(spark: SparkSession, lineitem: DataFrame, metrics: tuple[MetricSpec, ...],
                 fmt: str = "json") -> DataFrame:
    """Accepted rows with status, as a consumer stream appended them."""
    return read_consumer_output(spark, _consume(spark, lineitem, metrics, fmt))


def consumer_progress(spark: SparkSession, lineitem: DataFrame, metrics: tuple[MetricSpec, ...], fmt: str = "json") -> DataFrame:
    """The last of the running totals that a consumer stream committed batch by batch; `alerts` over all batches."""
    out = _consume(spark, lineitem, metrics, fmt)
    totals = progress_totals(spark, out)
    # one row a batch, and one consumer
    return totals.agg(F.sum("processed").alias("processed"), F.sum("alerts").alias("alerts"),
                      F.max_by(F.struct("total", "topics_seen", "line"), "batch_id").alias("t")).select("processed", "alerts", "t.*")


def topic_alerts(spark: SparkSession, lineitem: DataFrame, job: PairJobSpec, fmt: str = "json") -> DataFrame:
    """Topics → consumer stream → per-topic typed tables → the windowed job."""
    out = _consume(spark, lineitem, (job.first, job.second), fmt)
    return pair_alerts(*(read_metric_table(spark, out, m) for m in (job.first, job.second)), job)


LATE_SHARE = 100            # one row in so many arrives after all others


def corrected_run(spark: SparkSession, a: DataFrame, b: DataFrame, job: PairJobSpec, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Two metric feeds, a hundredth of the rows published last → the stream that corrects its windows → the result table."""
    work = scratch_path(spark, f"corrected-{job.label.lower()}")
    late = F.pmod(F.xxhash64("ts", "server_id"), F.lit(LATE_SHARE)) == 0
    feeds = []
    for k, (df, m) in {"a": (a, job.first), "b": (b, job.second)}.items():
        df = df.select("ts", "server_id", m.column)
        for part in (df.where(~late), df.where(late)):
            part.write.mode("append").parquet(f"{work}/{k}")
        feeds.append(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{work}/{k}"))
    start_corrected_alerts(*feeds, job, f"{work}/store", f"{work}/checkpoint", available_now=True).awaitTermination()
    return AlertStore(spark, f"{work}/store", job).alerts()


def _heartbeat(spark: SparkSession, last: int | None, value_cols: list[str], i: int) -> DataFrame:
    """One row ``i`` hours past the feed's last sample (microseconds), on the reserved heartbeat server."""
    return spark.range(1).select(
        (F.timestamp_micros(F.lit(last).cast("long")) + F.make_dt_interval(hours=F.lit(i))).alias("ts"),
        F.lit(HEARTBEAT_SERVER).alias("server_id"),
        *[F.lit(None).cast("float").alias(c) for c in value_cols])


def arrive(df: DataFrame, path: str, slice_s: int = SLICE_SECONDS) -> None:
    """Append a feed slice by slice of event time, as a live feed's files appear (files are streamed in that order)."""
    spark = df.sparkSession
    cut = F.floor(F.unix_seconds("ts") / slice_s).alias("slice")
    df.withColumn("slice", cut).repartition("slice", F.pmod(F.hash("server_id"), F.lit(4))) \
        .write.mode("overwrite").partitionBy("slice").parquet(f"{path}-slices")
    slices = spark.read.parquet(f"{path}-slices")
    for r in slices.select("slice").distinct().orderBy("slice").collect():     # one value a slice of time, not of data
        slices.where(F.col("slice") == r.slice).drop("slice").write.mode("append").parquet(path)


def windowed_run(spark: SparkSession, a: DataFrame, b: DataFrame, job: PairJobSpec, watermark: str = "5 minutes",
                 dense: bool = False, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Two metric feeds → windowed alert stream → finalised windows.

    The feeds arrive as files in order of event time and are consumed in triggers of ``files_per_trigger`` files a
    feed; then heartbeat rows are appended one at a time, each followed by a restart of the query from its checkpoint,
    so the watermark moves past the last window and the state is flushed. Rows that come later than the
    watermark allows are counted by the stream; if there are any, ``LateRows`` is raised instead of a result that
    silently lacks them.

    ``dense=False``: the non-empty windows as the stream emits them;
    ``dense=True``: the batch read of the sink densified and trimmed, which is
    the batch job's result table.
    """
    work = scratch_path(spark, f"window-stream-{job.label.lower()}")
    _to_the_end(spark, a, b, job, work, files_per_trigger, lambda sa, sb: start_windowed_alerts(
        sa, sb, job, f"{work}/out", f"{work}/checkpoint", watermark, available_now=True))
    return finish(read_windowed(spark, f"{work}/out"), job, dense=dense, sort=dense)


def dense_run(spark: SparkSession, a: DataFrame, b: DataFrame, job: PairJobSpec, watermark: str = "5 minutes",
              files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Two metric feeds → windowed alert stream → the sink that adds empty windows as the stream goes on; feeds as in ``windowed_run``."""
    work = scratch_path(spark, f"dense-stream-{job.label.lower()}")
    _to_the_end(spark, a, b, job, work, files_per_trigger, lambda sa, sb: start_dense_alerts(
        sa, sb, job, f"{work}/dense", f"{work}/checkpoint", watermark, available_now=True))
    return DenseSink(spark, f"{work}/dense", job).alerts()


def _to_the_end(spark: SparkSession, a: DataFrame, b: DataFrame, job: PairJobSpec, work: str, files_per_trigger: int,
                start: Callable[[DataFrame, DataFrame], StreamingQuery]) -> None:
    """Run a query over both feeds and their heartbeats until all windows are out; ``LateRows`` if rows were dropped."""
    feeds = {"a": (a, job.first.column), "b": (b, job.second.column)}
    staged, last = {}, {}
    for k, (df, col) in feeds.items():
        arrive(df.select("ts", "server_id", col), f"{work}/{k}")
        staged[k] = spark.read.parquet(f"{work}/{k}")
        last[k] = staged[k].agg(F.max(F.unix_micros("ts")).alias("us")).first().us

    def run(files: int) -> None:
        start(*(spark.readStream.schema(staged[k].schema).option("maxFilesPerTrigger", files).parquet(f"{work}/{k}")
                for k in ("a", "b"))).awaitTermination()
        late = late_rows(spark, f"{work}/checkpoint", job)
        if late:
            raise LateRows(f"{late} rows came later than the watermark allows; see {work}")

    run(files_per_trigger)
    for i in range(1, HEARTBEATS + 1):
        for k, (_, col) in feeds.items():
            _heartbeat(spark, last[k], [col], i).coalesce(1).write.mode("append").parquet(f"{work}/{k}")
        run(1)
