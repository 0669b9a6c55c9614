"""Command line: the producer, the two consumers and the two windowed jobs.

    python -m vigilo.cli produce  --wide dataset.csv --out topics/ [--format json|csv] [--kafka HOST:PORT]
    python -m vigilo.cli consume  --messages topics/ --group cpu-mem --out ingest/ [--stream --checkpoint ck/]
    python -m vigilo.cli live     --messages topics/ --group cpu-mem --out windows/ --checkpoint ck/ [--watermark "60 seconds"]
    python -m vigilo.cli cpu-mem  --ingest ingest/ --out results/        (what consume --stream wrote)
    python -m vigilo.cli cpu-mem  --cpu ingest/topic-cpu_csv --mem ingest/topic-mem_csv --out results/ [--team 103]
    python -m vigilo.cli net-disk --net ingest/topic-net_csv --disk ingest/topic-disk_csv --out results/

The caller's cluster settings apply (``spark-submit`` / defaults); nothing here
starts or stops anything beyond the Spark session.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .config import (
    CONSUMER_GROUP_CPU_MEM, CONSUMER_GROUP_NET_DISK, CPU_MEM_JOB, DEFAULT_TEAM_NO, NET_DISK_JOB,
)
from .operators.messages import accepted, decode_messages, rejects, split_wide, typed_table
from .plans.file_jobs import run_alert_job, run_alerts
from .plans.ingest_jobs import CONSUMERS
from .session import stage
from .sources import files, kafka
from .streaming.consumer import message_file_stream, read_metric_table, start_consumer
from .streaming.windows import start_topic_alerts

GROUPS = {"cpu-mem": CONSUMER_GROUP_CPU_MEM, "net-disk": CONSUMER_GROUP_NET_DISK}
JOBS = {"cpu-mem": CPU_MEM_JOB, "net-disk": NET_DISK_JOB}


def produce(spark: SparkSession, wide: str, out: str | None, fmt: str = "json", bootstrap: str | None = None):
    """Split the wide CSV into topic messages and publish them (files, or Kafka when given)."""
    msgs = split_wide(files.read_wide_csv(spark, wide), fmt)
    if bootstrap:
        kafka.publish(msgs, bootstrap)
    else:
        files.publish_messages(msgs, out)


def consume_batch(spark: SparkSession, messages: str | DataFrame, group: str, out: str, fmt: str = "json",
                  base_date: str | None = None) -> dict[str, str]:
    """Decode all published messages (a folder of files, or a frame) of a consumer group; append per-topic CSVs and rejects."""
    metrics = CONSUMERS[GROUPS[group]]
    if isinstance(messages, str):
        messages = files.read_messages(spark, messages, [m.topic for m in metrics])
    decoded = stage(decode_messages(messages, fmt, metrics, base_date), "decoded")
    paths = {}
    ok = accepted(decoded)
    for m in metrics:
        paths[m.topic] = f"{out}/{m.topic}_csv"
        files.append_metric_csv(typed_table(ok, m), paths[m.topic])
    rejects(decoded).write.mode("append").parquet(f"{out}/rejects")
    return paths


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="vigilo")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("produce")
    p.add_argument("--wide", required=True)
    p.add_argument("--out")
    p.add_argument("--format", default="json", choices=["json", "csv"])
    p.add_argument("--kafka")
    c = sub.add_parser("consume")
    c.add_argument("--messages")
    c.add_argument("--kafka")
    c.add_argument("--group", required=True, choices=sorted(GROUPS))
    c.add_argument("--out", required=True)
    c.add_argument("--format", default="json", choices=["json", "csv"])
    c.add_argument("--base-date")
    c.add_argument("--stream", action="store_true")
    c.add_argument("--checkpoint")
    v = sub.add_parser("live")
    v.add_argument("--messages")
    v.add_argument("--kafka")
    v.add_argument("--group", required=True, choices=sorted(GROUPS))
    v.add_argument("--out", required=True)
    v.add_argument("--format", default="json", choices=["json", "csv"])
    v.add_argument("--base-date")
    v.add_argument("--checkpoint")
    v.add_argument("--watermark", default="60 seconds")
    for name, (x, y) in {"cpu-mem": ("cpu", "mem"), "net-disk": ("net", "disk")}.items():
        j = sub.add_parser(name)
        j.add_argument(f"--{x}")
        j.add_argument(f"--{y}")
        j.add_argument("--ingest")
        j.add_argument("--out", required=True)
        j.add_argument("--team", default=DEFAULT_TEAM_NO)
        j.add_argument("--base-date")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"vigilo-{a.cmd}").getOrCreate()
    if a.cmd == "produce":
        produce(spark, a.wide, a.out, a.format, a.kafka)
    elif a.cmd in ("consume", "live"):
        metrics = CONSUMERS[GROUPS[a.group]]
        topics = [m.topic for m in metrics]
        checkpoint = a.checkpoint or f"{a.out}/_checkpoint"
        if a.cmd == "consume" and not a.stream:
            source = kafka.read_topics(spark, a.kafka, topics, stream=False) if a.kafka else a.messages
            consume_batch(spark, source, a.group, a.out, a.format, a.base_date)
            return
        source = kafka.read_topics(spark, a.kafka, topics) if a.kafka else message_file_stream(spark, a.messages)
        if a.cmd == "consume":
            q = start_consumer(source, a.out, checkpoint, metrics, a.format, a.base_date)
        else:
            q = start_topic_alerts(source, JOBS[a.group], a.out, checkpoint, a.format, a.base_date, watermark=a.watermark)
        q.awaitTermination()
    else:
        job = JOBS[a.cmd]
        first, second = (a.cpu, a.mem) if a.cmd == "cpu-mem" else (a.net, a.disk)
        counts: dict = {}
        if a.ingest:
            feeds = [read_metric_table(spark, a.ingest, m) for m in (job.first, job.second)]
            path = run_alerts(*feeds, job, a.out, a.team, counts)
        elif first and second:
            path = run_alert_job(spark, first, second, job, a.out, a.team, a.base_date, counts)
        else:
            ap.error(f"{a.cmd} needs --ingest or both metric files")
        print(f"[DONE] alerts saved to {path}; rows loaded: {counts}")


if __name__ == "__main__":
    main()
