"""Steps whose memory, time or written bytes grew with the input: how they are planned now, and that their rows are the same."""

import json
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from vigilo.config import CPU, CPU_MEM_JOB, MEM, NET, NET_DISK_JOB, WindowSpec
from vigilo.operators import messages as messages_module
from vigilo.operators import panes
from vigilo.operators.messages import decode_messages, split_wide
from vigilo.operators.pairing import pair_stats
from vigilo.plans.alert_jobs import pair_alerts, windows_of_keys
from vigilo.plans.file_jobs import ingest_to_csv, stage_wide_csv
from vigilo.plans.incremental import AlertStore
from vigilo.schemas import CPU_TABLE, MEM_TABLE
from vigilo.session import write_folders
from vigilo.sources.files import publish_messages, read_messages
from vigilo.sources.offsets import TopicLog, offset_ledger

T0 = datetime(2024, 1, 1)
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def settings(spark, monkeypatch):
    """The open files allowed to each write, as it began."""
    seen, plain = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kw):
        seen.append(spark.conf.get(OPEN_FILES, None))
        return plain(self, path, *args, **kw)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


def test_rows_are_not_sorted_into_their_folders(spark, tmp_dir, settings):
    rows = spark.range(0, 200, numPartitions=3).select((F.col("id") % 20).cast("string").alias("topic"), F.col("id").cast("string").alias("value"))
    publish_messages(rows, f"{tmp_dir}/topics")                               # more topics than files are kept open
    assert settings == ["8"] and spark.conf.get(OPEN_FILES, None) is None
    got = read_messages(spark, f"{tmp_dir}/topics").select("topic", "value")
    assert got.count() == 200 and got.select(F.col("topic").cast("string"), "value").exceptAll(rows).count() == 0
    write_folders(rows, f"{tmp_dir}/whole")
    assert spark.read.parquet(f"{tmp_dir}/whole").exceptAll(rows).count() == 0 and settings[1:] == [None]


def test_the_sessions_own_setting_stays(spark, tmp_dir, settings):
    spark.conf.set(OPEN_FILES, "2")
    try:
        publish_messages(spark.createDataFrame([("a", "1")], "topic string, value string"), f"{tmp_dir}/topics")
        assert settings == ["2"] and spark.conf.get(OPEN_FILES) == "2"
    finally:
        spark.conf.unset(OPEN_FILES)


TEXTS = ["", "1.5", " 7 ", "true", "false", "null", "NaN", "Infinity", "-Infinity", "1_0", "0x1", "1e5", "[1]", "{}", "{\"", "a\\b", "é", "\x01", "tab\there",
         "2024-01-01 00:00:05", "10:20:30", "a,b", "\":\"", "-1", "user-1", "\x7f", " "]


def test_producers_spelling_reads_as_the_parser_reads_it(spark):
    """Messages in the producer's spelling, and the same with a space more: the first are read without the parser, to the same fields."""
    rows, other = [], []
    for m in (CPU, MEM, NET):
        for i, a in enumerate(TEXTS):
            for b in (a, TEXTS[i - 1], "1.5"):
                for raw in (False, True):                                     # raw: what needs an escape stays as it is
                    keys = ["ts", "server_id", m.column, *m.extra_columns]
                    texts = [a, b, a if b != "1.5" else b, "2.5"][:len(keys)]
                    words = [f'"{t}"' if raw else json.dumps(t, ensure_ascii=False) for t in texts]
                    rows.append((m.topic, len(rows), "{" + ",".join(f'"{k}":{w}' for k, w in zip(keys, words)) + "}"))
                    other.append((m.topic, len(other), "{" + ", ".join(f'"{k}":{w}' for k, w in zip(keys, words)) + "}"))
    columns = "topic string, n int, value string"
    one, two = (decode_messages(spark.createDataFrame(x, columns)).drop("message").collect() for x in (rows, other))
    assert sorted(map(str, one)) == sorted(map(str, two)) and len({r.reason for r in one}) == 3


def test_producers_messages_need_no_parser(spark):
    wide = spark.createDataFrame([("2024-01-01 00:00:05", "srv-1", "1.0", "2.0", "3.0", "4.0", "5.0")],
                                 "ts string, server_id string, cpu_pct string, mem_pct string, net_in string, net_out string, disk_io string")
    fields = messages_module._with_json_fields(split_wide(wide), F.col("value"), messages_module.METRICS)
    assert fields.where("_plain and _parsed is null and not _unsure").count() == 4
    odd = spark.createDataFrame([(CPU.topic, '{"ts":"a","server_id":"b","cpu_pct":"1","cpu_pct":"2"}'), (CPU.topic, None)], "topic string, value string")
    assert messages_module._with_json_fields(odd, F.col("value"), messages_module.METRICS).where("_plain").count() == 0


def feeds(spark):
    times = [T0 + timedelta(seconds=s) for s in (3, 4, 50, 95, 400, 401, 9000, 9100)]
    return [spark.createDataFrame([(t, s, float(k * 7 % 90)) for k, t in enumerate(times) for s in ("a", "b", "c") if s != "c" or k > 4], schema)
            for schema in (CPU_TABLE, MEM_TABLE)]


@pytest.mark.parametrize("length, slide", [(3600, 10), (45, 10), (50, 20), (360, 1), (61, 60)])
def test_long_windows_without_warm_up(spark, monkeypatch, length, slide):
    a, b = feeds(spark)
    job = replace(CPU_MEM_JOB, window=WindowSpec(length, slide))
    stats = pair_stats(a, "cpu_pct", b, "mem_pct", "avg")
    every = {(r.server_id, r.w): r for r in windows_of_keys(stats, job, expand=0).collect()}
    first = min(r._lo for r in every.values())
    monkeypatch.setattr(panes, "GRID_ROWS", 10)
    got = windows_of_keys(stats, job, expand=0, aligned=True)
    assert {(r.server_id, r.w): r for r in got.collect()} == {k: r for k, r in every.items() if k[1] >= first}
    dense = pair_alerts(a, b, job).collect()
    assert len(dense) == 3 * (max(w for _, w in every) - first + 1)


def test_grid_is_dealt_by_its_rows_and_not_joined(spark, monkeypatch):
    a, b = feeds(spark)
    stats = pair_stats(a, "cpu_pct", b, "mem_pct", "avg")
    monkeypatch.setattr(panes, "GRID_ROWS", 100)
    plan = windows_of_keys(stats, replace(CPU_MEM_JOB, window=WindowSpec(3600, 10)), aligned=True)._jdf.queryExecution().optimizedPlan().toString()
    tasks = int(plan.split("RepartitionByExpression [server_id")[1].split("], ")[1].split()[0])
    assert tasks > 8 and "Join" not in plan


def test_partials_are_dealt_once(spark, tmp_dir):
    store = AlertStore(spark, f"{tmp_dir}/store", CPU_MEM_JOB)
    a, b = feeds(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for i in range(2):
            store.add(*(f.where(F.pmod(F.unix_seconds("ts"), F.lit(2)) == i) for f in (a, b)), i)
        new = store.partials.read_folder(store.partials.folders()[1])
        plan = store._computed_again(new)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(ts" not in plan and plan.count("SortMergeJoin") == 1
    assert store.alerts().exceptAll(pair_alerts(a, b, CPU_MEM_JOB)).count() == 0


def test_offsets_follow_tasks_and_rows(spark, tmp_dir):
    log = TopicLog(spark, f"{tmp_dir}/log")
    rows = spark.range(0, 3000, numPartitions=4).select((F.col("id") % 10).cast("string").alias("topic"), F.col("id").cast("string").alias("value"))
    log.publish(rows)
    got = log.messages.read().collect()
    assert {(int(r.topic), r.offset): int(r.value) for r in got} == {(i % 10, i // 10): i for i in range(3000)}


def test_distinct_offsets_are_counted_in_words(spark, tmp_dir):
    rows = spark.range(0, 1000, numPartitions=4).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("value"))
    out = offset_ledger(spark, rows, {"g": ("t",), "h": ("t",)}, f"{tmp_dir}/log", most=70)
    assert "distinct" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.collect())) == [(g, "t", 1000, 1000, 0, 999, 1000) for g in "gh"]


@pytest.mark.parametrize("job, fmt", [(CPU_MEM_JOB, "json"), (NET_DISK_JOB, "csv")])
def test_decoded_messages_go_straight_to_their_files(spark, tmp_dir, settings, job, fmt):
    from conftest import SF_SMALL
    lineitem = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    paths = ingest_to_csv(spark, stage_wide_csv(spark, lineitem, tmp_dir), job, tmp_dir, fmt)
    assert settings == []                                                     # no table of decoded messages between
    assert all(spark.read.option("header", True).csv(p).count() == lineitem.count() for p in paths.values())
