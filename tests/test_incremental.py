"""Alerts kept up to date batch by batch, and corrected by late rows, against the batch job over all rows."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vigilo.config import CPU_MEM_JOB, NET_DISK_JOB
from vigilo.plans.alert_jobs import pair_alerts
from vigilo.plans.incremental import AlertStore, start_corrected_alerts
from vigilo.schemas import CPU_TABLE, MEM_TABLE
from vigilo.sources.telemetry import load_metrics

T0 = datetime(2024, 1, 1)


def equal(got, want):
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("job, names", [(CPU_MEM_JOB, ("cpu", "mem")), (NET_DISK_JOB, ("net", "disk"))])
def test_three_batches_with_common_keys(spark, tmp_dir, job, names):
    from conftest import SF_SMALL
    m = load_metrics(spark, SF_SMALL)
    feeds = [m[n].select("ts", "server_id", mm.column).withColumn("slice", F.pmod(F.xxhash64("ts", "server_id", mm.column), F.lit(3)))
             for n, mm in zip(names, (job.first, job.second))]
    store = AlertStore(spark, f"{tmp_dir}/store", job, compact_every=2)
    for i in range(3):
        store.add(*[f.where(F.col("slice") == i).drop("slice") for f in feeds], i)
        so_far = pair_alerts(*[f.where(F.col("slice") <= i).drop("slice") for f in feeds], job)
        assert equal(store.alerts(), so_far) and so_far.count() > 0
    store.add(*[f.where(F.col("slice") == 2).drop("slice") for f in feeds], 2)           # repeated: replaces itself
    assert equal(store.alerts(), so_far)


def test_only_touched_windows_and_hours(spark, tmp_dir):
    """A batch in the second hour reads none of the first hours' partials, and writes its own windows only."""
    def frame(schema, hour, server, x):
        return spark.createDataFrame([(T0 + timedelta(hours=hour, seconds=s), server, x) for s in range(0, 60, 5)], schema)
    store = AlertStore(spark, f"{tmp_dir}/store", CPU_MEM_JOB)
    store.add(frame(CPU_TABLE, 1, "a", 95.0), frame(MEM_TABLE, 1, "a", 95.0), 0)
    store.add(frame(CPU_TABLE, 9, "b", 50.0), frame(MEM_TABLE, 9, "b", 50.0), 1)
    first = store.windows.read(upto=0)
    second = store.windows.read().exceptAll(first)
    assert first.select("server_id").distinct().collect() == [("a",)] and second.select("server_id").distinct().collect() == [("b",)]
    new = store.partials.read_folder(store.partials.folders()[1])
    plan = store._computed_again(new)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*hour", plan)


def test_empty_batches(spark, tmp_dir):
    none = spark.createDataFrame([], CPU_TABLE), spark.createDataFrame([], MEM_TABLE)
    store = AlertStore(spark, f"{tmp_dir}/store", CPU_MEM_JOB)
    store.add(*none, 0)
    assert store.alerts().count() == 0
    store.add(spark.createDataFrame([(T0, "a", 1.0)], CPU_TABLE), none[1], 1)
    assert store.alerts().count() == 0                                  # on one side only
    store.add(none[0], spark.createDataFrame([(T0, "a", 2.0), (None, "a", 3.0)], MEM_TABLE), 2)
    assert [tuple(r)[3:5] for r in store.alerts().collect()] == [(1.0, 2.0)]


def test_stream_with_late_rows_ends_as_the_batch_job(spark, tmp_dir):
    from conftest import SF_SMALL
    m = load_metrics(spark, SF_SMALL)
    late = F.pmod(F.xxhash64("ts", "server_id"), F.lit(50)) == 0
    for name in ("cpu", "mem"):
        by_time = m[name].where(~late).withColumn("slice", F.floor(F.unix_seconds("ts") / 200))
        slices = [r.slice for r in by_time.select("slice").distinct().orderBy("slice").collect()]
        for s in slices:
            by_time.where(F.col("slice") == s).drop("slice").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/{name}")
        m[name].where(late).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/{name}")
    def run():
        feeds = [spark.readStream.schema(m[n].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/{n}") for n in ("cpu", "mem")]
        start_corrected_alerts(*feeds, CPU_MEM_JOB, f"{tmp_dir}/store", f"{tmp_dir}/checkpoint", delay_s=60, available_now=True).awaitTermination()
    run()
    store = AlertStore(spark, f"{tmp_dir}/store", CPU_MEM_JOB)
    assert equal(store.alerts(), pair_alerts(m["cpu"], m["mem"], CPU_MEM_JOB))
    assert store.late.read().count() > 0
    rows = sum(r.rows for r in store.frontier.read().collect())
    assert rows == m["cpu"].count() + m["mem"].count()
    run()                                                               # nothing new: nothing changes
    assert equal(store.alerts(), pair_alerts(m["cpu"], m["mem"], CPU_MEM_JOB))
