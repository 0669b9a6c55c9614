"""Scans and sinks, and the command-line flow produce → consume → windowed job."""

import glob

import pytest
from pyspark.sql import functions as F

from vigilo import cli
from vigilo.config import CPU, MEM, NET
from vigilo.plans.registry import q_cpu_mem_alerts, q_net_disk_alerts
from vigilo.schemas import result_schema
from vigilo.sources.files import read_metric_csv, read_result_csv, read_wide_csv, write_csv
from vigilo.sources.telemetry import read_table, wide_text


def test_metric_csv_legacy_layout_and_base_date(spark, tmp_dir):
    # the monitored consumers' layout: ts as HH:MM:SS text, no event_ts column
    p = f"{tmp_dir}/cpu.csv"
    with open(p, "w") as f:
        f.write("ts,server_id,cpu_pct\n23:59:59,s1,91.5\n00:00:01,s1,abc\n")
    no_base = read_metric_csv(spark, p, CPU).collect()
    assert [r.ts for r in no_base] == [None, None]          # never today's date
    based = read_metric_csv(spark, p, CPU, base_date="2024-05-01").orderBy("ts").collect()
    assert [r.ts.strftime("%Y-%m-%d %H:%M:%S") for r in based] == ["2024-05-01 00:00:01", "2024-05-01 23:59:59"]
    assert [r.cpu_pct for r in based] == [None, 91.5]       # bad number reads as NULL


def test_net_csv_keeps_net_out(spark, tmp_dir):
    p = f"{tmp_dir}/net.csv"
    with open(p, "w") as f:
        f.write("ts,server_id,net_in,net_out,event_ts\n10:00:00,s,1.5,2.5,2024-01-01T10:00:00.000Z\n")
    r = read_metric_csv(spark, p, NET).collect()[0]
    assert (r.net_in, r.net_out, r.ts.strftime("%H:%M:%S")) == (1.5, 2.5, "10:00:00")


def test_cli_flow_equals_direct_jobs(spark, tmp_dir):
    from conftest import SF_SMALL
    li = read_table(spark, SF_SMALL, "lineitem")
    write_csv(wide_text(li), f"{tmp_dir}/dataset")
    cli.produce(spark, f"{tmp_dir}/dataset", f"{tmp_dir}/topics", "json")
    p1 = cli.consume_batch(spark, f"{tmp_dir}/topics", "cpu-mem", f"{tmp_dir}/ingest")
    p2 = cli.consume_batch(spark, f"{tmp_dir}/topics", "net-disk", f"{tmp_dir}/ingest")
    assert set(p1) == {"topic-cpu", "topic-mem"} and set(p2) == {"topic-net", "topic-disk"}
    counts = {}
    out = cli.run_alert_job(spark, p1["topic-cpu"], p1["topic-mem"], cli.CPU_MEM_JOB, f"{tmp_dir}/res",
                            counts=counts)
    n = li.count()
    assert counts == {"cpu_pct": n, "mem_pct": n}
    assert out.endswith("team_103_CPU_MEM.csv") and glob.glob(f"{out}/part-*")
    got = read_result_csv(spark, out, result_schema("avg_cpu", "avg_mem", "avg"))
    want = q_cpu_mem_alerts(spark, SF_SMALL)       # CPU/MEM text values equal the typed ones
    assert got.count() == want.count() == 610
    assert got.exceptAll(want).count() == 0
    out2 = cli.run_alert_job(spark, p2["topic-net"], p2["topic-disk"], cli.NET_DISK_JOB, f"{tmp_dir}/res")
    got2 = read_result_csv(spark, out2, result_schema("max_net_in", "max_disk_io", "max"))
    assert got2.count() == q_net_disk_alerts(spark, SF_SMALL).count()
    assert spark.read.parquet(f"{tmp_dir}/ingest/rejects").count() == 0


def test_csv_cells(spark, tmp_dir):
    with open(f"{tmp_dir}/cpu.csv", "w") as f:
        f.write("ts,server_id,cpu_pct\n2024-01-01 00:00:01,a,nan\n2024-01-01 00:00:01,b,inf\n2024-01-01 00:00:01,c,91.5\n")
    assert [r.cpu_pct for r in read_metric_csv(spark, f"{tmp_dir}/cpu.csv", CPU).orderBy("server_id").collect()] == [None, None, 91.5]
    with open(f"{tmp_dir}/wide.csv", "w") as f:
        f.write('ts,server_id,cpu_pct,mem_pct,net_in,net_out,disk_io\nt,"a""b",,50,1,2,3\n')
    r = read_wide_csv(spark, f"{tmp_dir}/wide.csv").collect()[0]
    assert (r.server_id, r.cpu_pct, r.mem_pct) == ('a"b', "", "50")


def test_rows_without_a_timestamp_are_an_error(spark, tmp_dir):
    for name in ("cpu", "mem"):
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write(f"ts,server_id,{name}_pct\n00:00:01,a,1\n")
    args = (spark, f"{tmp_dir}/cpu.csv", f"{tmp_dir}/mem.csv", cli.CPU_MEM_JOB, f"{tmp_dir}/res")
    with pytest.raises(ValueError, match="base_date"):
        cli.run_alert_job(*args)
    counts = {}
    cli.run_alert_job(*args, base_date="2024-01-01", counts=counts)
    assert counts == {"cpu_pct": 1, "mem_pct": 1}


def test_result_order_kept_across_part_files(spark, tmp_dir):
    from conftest import SF_SMALL
    res = q_cpu_mem_alerts(spark, SF_SMALL)
    write_csv(res, f"{tmp_dir}/r")
    parts = sorted(glob.glob(f"{tmp_dir}/r/part-*.csv"))
    rows = []
    for p in parts:
        with open(p) as f:
            rows += [line.split(",")[:2] for line in f.read().splitlines()[1:]]
    assert rows == sorted(rows, key=lambda r: (r[0], r[1]))
    assert len(rows) == 610
    assert MEM.column == "mem_pct" and F is not None


def test_cli_main_argument_wiring(spark, tmp_dir, capsys):
    from conftest import SF_SMALL
    write_csv(wide_text(read_table(spark, SF_SMALL, "lineitem")), f"{tmp_dir}/dataset")
    cli.main(["produce", "--wide", f"{tmp_dir}/dataset", "--out", f"{tmp_dir}/topics", "--format", "csv"])
    cli.main(["consume", "--messages", f"{tmp_dir}/topics", "--group", "net-disk", "--out", f"{tmp_dir}/in",
              "--format", "csv"])
    cli.main(["net-disk", "--net", f"{tmp_dir}/in/topic-net_csv", "--disk", f"{tmp_dir}/in/topic-disk_csv",
              "--out", f"{tmp_dir}/res", "--team", "7"])
    out = capsys.readouterr().out
    assert "team_7_NET_DISK.csv" in out and "rows loaded" in out
    got = read_result_csv(spark, f"{tmp_dir}/res/team_7_NET_DISK.csv", result_schema("max_net_in", "max_disk_io", "max"))
    assert got.count() == 610


def test_kafka_adapter_fails_clearly_without_connector(spark):
    from vigilo.sources import kafka
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.read_topics(spark, "localhost:9", ["topic-cpu", "topic-mem"], stream=True)
