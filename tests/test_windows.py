"""Hand goldens for the windowed alert jobs (window edges, weighting, NULLs, boundaries)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vigilo.config import CPU_MEM_JOB, NET_DISK_JOB, WindowSpec
from vigilo.plans.alert_jobs import cpu_mem_alerts, joined_pairs, net_disk_alerts
from vigilo.schemas import CPU_TABLE, DISK_TABLE, MEM_TABLE, metric_table
from vigilo.sources.telemetry import load_metrics
from vigilo.operators.windows import spine

T0 = datetime(2024, 1, 1, 0, 0, 5)


def ts(sec):
    return datetime(2024, 1, 1, 0, sec // 60, sec % 60) if sec < 3600 else None


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_warmup_trim_and_dense_and_half_open(spark):
    # samples at 00:00:05 and 00:00:30 (exactly the end of window 00:00:00-00:00:30)
    cpu = frame(spark, CPU_TABLE, [(ts(5), "s1", 10.0), (ts(30), "s1", 20.0)])
    mem = frame(spark, MEM_TABLE, [(ts(5), "s1", 1.0), (ts(30), "s1", 2.0)])
    out = rows_of(cpu_mem_alerts(cpu, mem))
    starts = [r[1] for r in out]
    assert starts == ["00:00:00", "00:00:10", "00:00:20", "00:00:30"]       # no warm-up windows
    assert out[0][3:5] == (10.0, 1.0)                                       # 00:00:30 not in [00:00, 00:30)
    assert out[3][3:5] == (20.0, 2.0)


def test_empty_window_has_nulls(spark):
    cpu = frame(spark, CPU_TABLE, [(ts(0), "s1", 10.0), (ts(100), "s1", 20.0)])
    mem = frame(spark, MEM_TABLE, [(ts(0), "s1", 1.0), (ts(100), "s1", 2.0)])
    out = {r[1]: r for r in rows_of(cpu_mem_alerts(cpu, mem))}
    assert len(out) == 11                                   # starts 00:00:00 .. 00:01:40
    assert out["00:00:40"][3:] == (None, None, None)
    assert out["00:01:40"][3:5] == (20.0, 2.0)


def test_join_multiplicity_weights_average(spark):
    # 2 cpu x 3 mem on one key, plus 1 x 1 on another key in the same window
    cpu = frame(spark, CPU_TABLE, [(ts(1), "s", 10.0), (ts(1), "s", 20.0), (ts(2), "s", 40.0)])
    mem = frame(spark, MEM_TABLE, [(ts(1), "s", 1.0), (ts(1), "s", 2.0), (ts(1), "s", 3.0), (ts(2), "s", 9.0)])
    first = rows_of(cpu_mem_alerts(cpu, mem))[0]
    # joined rows: cpu (10,20) each x3 + 40 -> (30+60+40)/7 ; mem (1+2+3)*2 + 9 -> 21/7
    assert first[3] == round((10 * 3 + 20 * 3 + 40) / 7, 2)
    assert first[4] == 3.0
    literal = joined_pairs(cpu, mem, CPU_MEM_JOB)
    assert literal.count() == 7


def test_one_sided_server_absent_and_null_keys_drop(spark):
    cpu = frame(spark, CPU_TABLE, [(ts(1), "a", 10.0), (ts(1), "only_cpu", 10.0), (None, "a", 5.0)])
    mem = frame(spark, MEM_TABLE, [(ts(1), "a", 1.0), (ts(1), None, 1.0)])
    out = rows_of(cpu_mem_alerts(cpu, mem))
    assert {r[0] for r in out} == {"a"}


def test_null_metric_gives_null_alert(spark):
    cpu = frame(spark, CPU_TABLE, [(ts(1), "s", 99.0)])
    mem = frame(spark, MEM_TABLE, [(ts(1), "s", None)])
    r = rows_of(cpu_mem_alerts(cpu, mem))[0]
    assert r[3] == 99.0 and r[4] is None and r[5] is None


def test_cpu_mem_threshold_equality_no_alert(spark):
    cpu = frame(spark, CPU_TABLE, [(ts(1), "s", 89.65), (ts(1), "t", 89.66)])
    mem = frame(spark, MEM_TABLE, [(ts(1), "s", 89.73), (ts(1), "t", 89.74)])
    out = {r[0]: r for r in rows_of(cpu_mem_alerts(cpu, mem))}
    assert out["s"][5] is None
    assert out["t"][5] == "High CPU + Memory stress"


def test_net_disk_float_boundary_alerts(spark):
    net = frame(spark, metric_table("net_in"), [(ts(1), "s", 7205.16)])
    disk = frame(spark, DISK_TABLE, [(ts(1), "s", 4220.24)])
    r = rows_of(net_disk_alerts(net, disk))[0]
    assert r[5] == "Network flood + Disk thrash suspected"     # float32 value is above the double threshold
    assert dict(zip(net_disk_alerts(net, disk).columns, r))["max_net_in"] == pytest.approx(7205.16)


def test_alert_branches(spark):
    cpu = frame(spark, CPU_TABLE, [(ts(1), "both", 95.0), (ts(1), "cpu", 95.0), (ts(1), "mem", 10.0),
                                   (ts(1), "none", 10.0)])
    mem = frame(spark, MEM_TABLE, [(ts(1), "both", 95.0), (ts(1), "cpu", 10.0), (ts(1), "mem", 95.0),
                                   (ts(1), "none", 10.0)])
    out = {r[0]: r[5] for r in rows_of(cpu_mem_alerts(cpu, mem))}
    assert out == {"both": "High CPU + Memory stress", "cpu": "CPU spike suspected",
                   "mem": "Memory saturation suspected", "none": None}


def test_empty_input_right_schema(spark):
    cpu = frame(spark, CPU_TABLE, [])
    mem = frame(spark, MEM_TABLE, [])
    out = cpu_mem_alerts(cpu, mem)
    assert out.count() == 0
    assert out.columns == ["server_id", "window_start", "window_end", "avg_cpu", "avg_mem", "alert"]


def test_window_spec_validation():
    with pytest.raises(ValueError):
        WindowSpec(30, 7).validate()
    assert WindowSpec(30, 10).per_sample == 3


def _literal_range_join(spark, a, b, job):
    """The monitored job's own form: pair join, then a right outer range join to the spine."""
    j = joined_pairs(a, b, job)
    s = job.window.slide_s
    keys = j.groupBy("server_id").agg(F.floor(F.unix_seconds(F.min("ts")) / s).cast("long").alias("lo"),
                                      F.floor(F.unix_seconds(F.max("ts")) / s).cast("long").alias("hi"))
    sp = spine(keys, 4).withColumnRenamed("server_id", "ws")
    sp = sp.withColumn("st", F.timestamp_seconds(F.col("w") * s)) \
           .withColumn("en", F.timestamp_seconds(F.col("w") * s + job.window.length_s))
    r = j.join(sp, (j.server_id == sp.ws) & (j.ts >= sp.st) & (j.ts < sp.en), "right")
    agg = F.avg if job.how == "avg" else F.max
    return r.groupBy(F.col("ws").alias("server_id"), "w").agg(
        F.round(agg(job.first.column), 2).alias("x"), F.round(agg(job.second.column), 2).alias("y"))


@pytest.mark.parametrize("job", [CPU_MEM_JOB, NET_DISK_JOB], ids=["cpu_mem", "net_disk"])
def test_equivalent_to_literal_range_join(spark, job):
    from conftest import SF_SMALL
    m = load_metrics(spark, SF_SMALL)
    a, b = (m["cpu"], m["mem"]) if job is CPU_MEM_JOB else (m["net"].drop("net_out"), m["disk"])
    ours = cpu_mem_alerts(a, b) if job is CPU_MEM_JOB else net_disk_alerts(a, b)
    ours = ours.select("server_id", "window_start", F.col(job.out_first).alias("x"), F.col(job.out_second).alias("y"))
    lit = _literal_range_join(spark, a, b, job).select(
        "server_id", F.date_format(F.timestamp_seconds(F.col("w") * 10), "HH:mm:ss").alias("window_start"), "x", "y")
    assert ours.count() == lit.count() == 610
    assert ours.exceptAll(lit).count() == 0 and lit.exceptAll(ours).count() == 0


def test_shuffled_input_same_result(spark):
    from conftest import SF_SMALL
    m = load_metrics(spark, SF_SMALL)
    base = cpu_mem_alerts(m["cpu"], m["mem"])
    shuffled = cpu_mem_alerts(m["cpu"].repartition(7), m["mem"].orderBy(F.rand(3)))
    assert base.exceptAll(shuffled).count() == 0


def test_properties_dense_grid_and_alert_consistency(spark):
    from conftest import SF_SMALL
    m = load_metrics(spark, SF_SMALL)
    out = cpu_mem_alerts(m["cpu"], m["mem"]).cache()
    servers = out.select("server_id").distinct().count()
    starts = out.select("window_start").distinct().count()
    assert out.count() == servers * starts
    bad = out.where(
        ((F.col("alert") == "High CPU + Memory stress") & ~((F.col("avg_cpu") > 89.65) & (F.col("avg_mem") > 89.73)))
        | (F.col("alert").isNull() & F.col("avg_cpu").isNotNull() & F.col("avg_mem").isNotNull()
           & ((F.col("avg_cpu") > 89.65) | (F.col("avg_mem") > 89.73))))
    assert bad.count() == 0
    out.unpersist()


def test_spine_spans_many_chunks(spark):
    from vigilo.operators.windows import SPINE_CHUNK
    lo, hi = 1000, 1000 + 2 * SPINE_CHUNK + 37              # crosses three chunk boundaries
    extent = spark.createDataFrame([("a", lo, lo + 5), ("b", hi - 3, hi)], "server_id string, lo long, hi long")
    sp = spine(extent, 4)
    n = hi - lo + 1
    stats = sp.groupBy("server_id").agg(F.count("w").alias("n"), F.countDistinct("w").alias("d"),
                                        F.min("w").alias("lo"), F.max("w").alias("hi")).collect()
    assert sorted(tuple(r) for r in stats) == [("a", n, n, lo, hi), ("b", n, n, lo, hi)]


def test_long_span_dense_through_the_job(spark):
    t0, t1 = datetime(2024, 1, 1, 0, 0, 0), datetime(2024, 1, 1, 6, 0, 0)     # 2160 slides apart
    cpu = frame(spark, CPU_TABLE, [(t0, "s", 95.0), (t1, "s", 10.0)])
    mem = frame(spark, MEM_TABLE, [(t0, "s", 95.0), (t1, "s", 10.0)])
    out = cpu_mem_alerts(cpu, mem)
    rows = rows_of(out)
    assert len(rows) == 2161
    assert rows[0][1:3] == ("00:00:00", "00:00:30") and rows[-1][1] == "06:00:00"
    # the first sample's two earlier windows start before the first aligned start (trimmed);
    # the last sample is in 05:59:40, 05:59:50 and 06:00:00
    assert sum(r[3] is not None for r in rows) == 4
