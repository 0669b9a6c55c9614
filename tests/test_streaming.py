"""Structured Streaming: consumer resume from checkpoint, batch == stream, windowed stream."""

import pytest
from pyspark.sql import functions as F

from vigilo.config import CPU, CPU_MEM_JOB, MEM
from vigilo.operators.messages import split_wide
from vigilo.plans.ingest_jobs import CONSUMER_1, STATUS_COLUMNS, consume
from vigilo.plans.alert_jobs import finish
from vigilo.plans.stream_jobs import LateRows, windowed_run
from vigilo.plans.window_reports import nonempty_windows
from vigilo.schemas import WIDE_TEXT
from vigilo.sources.files import publish_messages
from vigilo.sources.telemetry import load_metrics
from vigilo.streaming.consumer import (
    message_file_stream, progress_line, progress_totals, read_consumer_output, read_metric_table, start_consumer,
)
from vigilo.streaming.windows import HEARTBEAT_SERVER, read_windowed, start_topic_alerts


def _wide_rows(n, start=0):
    return [(f"2024-01-01 00:{(i // 60) % 60:02d}:{i % 60:02d}", f"s{i % 3}", f"{80 + i % 20}.5", "50.25",
             "1.0", "2.0", "3.0") for i in range(start, start + n)]


def test_consumer_resumes_from_checkpoint(spark, tmp_dir):
    topics, out, ckpt = f"{tmp_dir}/topics", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    publish_messages(split_wide(spark.createDataFrame(_wide_rows(20), WIDE_TEXT), "json", CONSUMER_1), topics)
    q = start_consumer(message_file_stream(spark, topics), out, ckpt, CONSUMER_1, available_now=True)
    q.awaitTermination()
    assert read_consumer_output(spark, out).count() == 40
    seen = [p["observedMetrics"]["progress"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(int(o["processed"]) for o in seen) == 40
    assert sum(int(o["processed_topic-cpu"]) for o in seen) == 20
    assert progress_line({k: int(v) for k, v in seen[-1].asDict().items()}).startswith("Processed ")
    # new messages arrive; a restarted consumer only processes those
    publish_messages(split_wide(spark.createDataFrame(_wide_rows(10, 20), WIDE_TEXT), "json", CONSUMER_1), topics)
    q = start_consumer(message_file_stream(spark, topics), out, ckpt, CONSUMER_1, available_now=True)
    q.awaitTermination()
    got = read_consumer_output(spark, out)
    assert got.count() == 60
    assert got.groupBy("topic", "server_id", "ts").count().where("count > 1").count() == 0


def test_stream_equals_batch(spark, tmp_dir):
    wide = spark.createDataFrame(_wide_rows(50), WIDE_TEXT)
    msgs = split_wide(wide, "json", CONSUMER_1)
    batch = consume(msgs, CONSUMER_1).select(*STATUS_COLUMNS)
    publish_messages(msgs, f"{tmp_dir}/topics")
    q = start_consumer(message_file_stream(spark, f"{tmp_dir}/topics", 1), f"{tmp_dir}/out", f"{tmp_dir}/ck",
                       CONSUMER_1, available_now=True)
    q.awaitTermination()
    stream = read_consumer_output(spark, f"{tmp_dir}/out").select(*STATUS_COLUMNS)
    assert batch.exceptAll(stream).count() == 0 and stream.exceptAll(batch).count() == 0


def test_windowed_stream_equals_batch_nonempty(spark):
    from conftest import SF_SMALL
    m = load_metrics(spark, SF_SMALL)
    stream = windowed_run(spark, m["cpu"], m["mem"], CPU_MEM_JOB)
    batch = nonempty_windows(m["cpu"], m["mem"], CPU_MEM_JOB)
    assert stream.count() == batch.count() > 0
    assert stream.exceptAll(batch).count() == 0
    assert batch.where(F.col("window_start") < "00:00:00").count() == 0


def test_second_checkpoint_keeps_earlier_rows(spark, tmp_dir):
    wide = spark.createDataFrame(_wide_rows(20), WIDE_TEXT)
    publish_messages(split_wide(wide, "json", CONSUMER_1), f"{tmp_dir}/t")
    for ck in ("one", "two"):
        start_consumer(message_file_stream(spark, f"{tmp_dir}/t"), f"{tmp_dir}/out", f"{tmp_dir}/{ck}", CONSUMER_1,
                       available_now=True).awaitTermination()
    assert read_consumer_output(spark, f"{tmp_dir}/out").count() == 80


def test_running_totals(spark, tmp_dir):
    for n in range(3):
        publish_messages(split_wide(spark.createDataFrame(_wide_rows(10, 10 * n), WIDE_TEXT).coalesce(1), "json", CONSUMER_1), f"{tmp_dir}/t")
        start_consumer(message_file_stream(spark, f"{tmp_dir}/t"), f"{tmp_dir}/out", f"{tmp_dir}/ck", CONSUMER_1,
                       available_now=True).awaitTermination()
    rows = progress_totals(spark, f"{tmp_dir}/out").orderBy("batch_id").collect()
    assert [(r.processed, r.total, r.topics_seen) for r in rows] == [(20, 20, 2), (20, 40, 2), (20, 60, 2)]
    assert rows[-1].line == "Processed 60 total messages | Avg per topic ≈ 30.00"


def _long_feed(spark, column):
    """Two hours, a sample every 5 s on two servers."""
    return spark.range(0, 7200, 5).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("ts"),
                                          F.explode(F.array(F.lit("a"), F.lit("b"))).alias("server_id"),
                                          (F.col("id") % 100).cast("float").alias(column))


def test_many_triggers_beyond_the_watermark(spark):
    a, b = _long_feed(spark, "cpu_pct"), _long_feed(spark, "mem_pct")
    stream = windowed_run(spark, a, b, CPU_MEM_JOB, files_per_trigger=16)
    batch = nonempty_windows(a, b, CPU_MEM_JOB)
    assert stream.count() == batch.count() == 2 * 722
    assert stream.exceptAll(batch).count() == 0


def test_rows_beyond_the_watermark_are_reported(spark, monkeypatch):
    from vigilo.plans import stream_jobs

    def backwards(df, path):
        for half_hour in (3, 2, 1, 0):
            df.where(F.floor((F.unix_seconds("ts") - 1704067200) / 1800) == half_hour).coalesce(1).write.mode("append").parquet(path)
    monkeypatch.setattr(stream_jobs, "arrive", backwards)
    with pytest.raises(LateRows):
        windowed_run(spark, _long_feed(spark, "cpu_pct"), _long_feed(spark, "mem_pct"), CPU_MEM_JOB, files_per_trigger=1)


def test_topics_to_live_alerts_and_typed_tables(spark, tmp_dir):
    rows = _wide_rows(120)
    last = [(f"2024-01-01 0{h}:00:00", HEARTBEAT_SERVER, "0", "0", "0", "0", "0") for h in (2, 3, 4)]
    for part in (rows, *[[r] for r in last]):
        publish_messages(split_wide(spark.createDataFrame(part, WIDE_TEXT).coalesce(1), "json", CONSUMER_1), f"{tmp_dir}/t")
        q = start_topic_alerts(message_file_stream(spark, f"{tmp_dir}/t"), CPU_MEM_JOB, f"{tmp_dir}/w", f"{tmp_dir}/ck",
                               available_now=True)
        q.awaitTermination()
    got = finish(read_windowed(spark, f"{tmp_dir}/w"), CPU_MEM_JOB, dense=False, sort=False)
    start_consumer(message_file_stream(spark, f"{tmp_dir}/t"), f"{tmp_dir}/out", f"{tmp_dir}/ck2", CONSUMER_1,
                   available_now=True).awaitTermination()
    cpu, mem = (read_metric_table(spark, f"{tmp_dir}/out", m).where(F.col("server_id") != HEARTBEAT_SERVER) for m in (CPU, MEM))
    want = nonempty_windows(cpu, mem, CPU_MEM_JOB)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
