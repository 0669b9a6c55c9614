"""Continuous consumers (Structured Streaming), same functions as batch.

``start_consumer`` reads topic messages from a stream (Kafka via
``sources.kafka.read_topics`` or published message files), decodes them,
attaches per-message status and appends accepted rows and rejects. The
checkpoint replaces the consumer group's committed offsets: a restarted query
resumes where it stopped.

A micro-batch is one commit of ``sources.commits`` under the stream's id, below ``rows``: readers see all of
it or nothing, a batch replayed after a failure replaces its own earlier attempt for them at once, a
consumer started from another checkpoint never touches rows of an earlier one, and old batches are merged,
so files stay few. ``read_metric_table`` gives a topic's typed table (partitions of other topics are not
read), which the windowed jobs scan. Each batch also commits a row a topic below ``counters``, taken while
the batch was written; ``progress_totals`` adds those up and reads no messages.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import METRICS, PROGRESS_FORMAT, MetricSpec
from ..functions.metrics import format_columns, over_threshold
from ..operators.messages import decode_messages, typed_table, with_status
from ..schemas import MESSAGES
from ..sources.commits import CommittedTable

FILES_PER_TRIGGER = 256      # bounds a micro-batch, the first one over a backlog too


def message_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Stream of published message files (parquet, partitioned by topic)."""
    return spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


PROGRESS = "progress"


def with_progress(decoded: DataFrame, metrics: tuple[MetricSpec, ...]) -> DataFrame:
    """Attach per-micro-batch counters (the consumers' periodic progress line).

    Read them from ``query.lastProgress["observedMetrics"]["progress"]``:
    ``processed``, ``rejected``, ``alerts`` and ``processed_<topic>`` per topic.
    """
    ok = ~F.col("skipped") & F.col("reason").isNull()
    v = F.col("value")
    thr = None
    for m in metrics:
        c = F.col("topic") == m.topic
        thr = F.when(c, F.lit(float(m.threshold))) if thr is None else thr.when(c, F.lit(float(m.threshold)))
    alert = ok & over_threshold(v, thr)
    cols = [F.count_if(ok).alias("processed"), F.count_if(F.col("reason").isNotNull()).alias("rejected"),
            F.count_if(alert).alias("alerts")]
    cols += [F.count_if(ok & (F.col("topic") == m.topic)).alias(f"processed_{m.topic}") for m in metrics]
    return decoded.observe(PROGRESS, *cols)


def progress_line(observed: dict) -> str:
    """The consumers' progress line (``PROGRESS_FORMAT``) from one batch's observed counters."""
    per_topic = [v for k, v in observed.items() if k.startswith("processed_") and v]
    total = observed.get("processed", 0)
    return PROGRESS_FORMAT.format(total=total, avg=total / max(len(per_topic), 1))


def output_table(spark: SparkSession, out_dir: str) -> CommittedTable:
    """Decoded messages with their status, by ``kind`` (accepted or rejected) and topic."""
    return CommittedTable(spark, f"{out_dir}/rows", ("kind", "topic"))


def counter_table(spark: SparkSession, out_dir: str) -> CommittedTable:
    """``run, batch_id, topic, processed, alerts``: a row for each topic that a batch had accepted messages of."""
    return CommittedTable(spark, f"{out_dir}/counters")


def _batch_writer(out_dir: str, metrics: tuple[MetricSpec, ...]):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")   # kept by the checkpoint
        rows, counters = output_table(spark, out_dir), counter_table(spark, out_dir)
        if rows.is_merged(batch_id, run):
            return
        kind = F.when(F.col("reason").isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
        out = with_status(batch.where(~F.col("skipped")), metrics).drop("skipped").withColumn("kind", kind)
        seen = Observation()
        mine = {m.topic: (F.col("kind") == "accepted") & (F.col("topic") == m.topic) for m in metrics}
        rows.commit(out.observe(seen, *[F.count_if(c).alias(f"processed {t}") for t, c in mine.items()],
                                *[F.count_if(c & F.col("is_alert")).alias(f"alerts {t}") for t, c in mine.items()]), batch_id, run)
        n = seen.get
        counted = [(run, batch_id, t, n[f"processed {t}"], n[f"alerts {t}"]) for t in mine if n[f"processed {t}"]]
        counters.commit(spark.createDataFrame(counted, "run string, batch_id long, topic string, processed long, alerts long"), batch_id, run)
    return write


def start_consumer(messages: DataFrame, out_dir: str, checkpoint: str, metrics: Iterable[MetricSpec] = METRICS,
                   fmt: str = "json", base_date: str | None = None, available_now: bool = False,
                   processing_time: str | None = None, name: str | None = None) -> StreamingQuery:
    """Start a consumer stream; returns the running query."""
    metrics = tuple(metrics)
    decoded = with_progress(decode_messages(messages, fmt, metrics, base_date), metrics)
    w = (decoded.writeStream.foreachBatch(_batch_writer(out_dir, metrics))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_consumer_output(spark: SparkSession, out_dir: str, kind: str = "accepted") -> DataFrame:
    """Batch view of a consumer's output (``accepted`` or ``rejected``) as committed now."""
    return output_table(spark, out_dir).read().where(F.col("kind") == kind).drop("kind")


def read_metric_table(spark: SparkSession, out_dir: str, metric: MetricSpec) -> DataFrame:
    """A topic's accepted rows as the windowed jobs read them: ``ts`` (full time), ``server_id``, float values."""
    typed = typed_table(read_consumer_output(spark, out_dir), metric)
    return typed.select(F.col("event_ts").alias("ts"), "server_id",
                        *[F.col(c).cast("float").alias(c) for c in (metric.column, *metric.extra_columns)])


def progress_totals(spark: SparkSession, out_dir: str) -> DataFrame:
    """Totals after each micro-batch: ``batch_id, processed, alerts, total, topics_seen, line`` (the progress line).

    Added up from the counters that the batches committed, so they survive restarts; one row a batch of a run. Topics seen are those
    of the run so far.
    """
    batches = counter_table(spark, out_dir).read().groupBy("run", "batch_id").agg(
        F.sum("processed").alias("processed"), F.sum("alerts").alias("alerts"), F.collect_set("topic").alias("topics"))  # topics: one a metric at most
    so_far = Window.partitionBy("run").orderBy("batch_id")
    seen = F.size(F.array_distinct(F.flatten(F.collect_list("topics").over(so_far))))
    out = batches.select("run", "batch_id", "processed", "alerts", F.sum("processed").over(so_far).alias("total"), seen.alias("topics_seen"))
    line = format_columns(PROGRESS_FORMAT.replace("{avg:.2f}", "{avg}"), total=F.col("total").cast("string"),
                          avg=F.format_string("%.2f", F.col("total") / F.greatest("topics_seen", F.lit(1))))
    return out.withColumn("line", line)
