"""A third of all rows on one server and one timestamp: exact results, no m*n blow-up."""

import time

from pyspark.sql import functions as F

from vigilo.config import CPU_MEM_JOB
from vigilo.plans.alert_jobs import cpu_mem_alerts
from vigilo.sources.telemetry import load_metrics
from test_windows import _literal_range_join
from conftest import SF_SMALL


def _hot(df):
    hot = F.col("_hot")
    return (df.withColumn("_hot", F.col("server_id").substr(5, 3).cast("int") % 3 == 0)
              .withColumn("server_id", F.when(hot, F.lit("srv-hot")).otherwise(F.col("server_id")))
              .withColumn("ts", F.when(hot, F.timestamp_seconds(F.lit(1704067205))).otherwise(F.col("ts")))
              .drop("_hot"))


def test_hot_key_exact_against_literal_join(spark):
    m = load_metrics(spark, SF_SMALL)
    cpu, mem = _hot(m["cpu"]), _hot(m["mem"])
    n_hot = cpu.where("server_id = 'srv-hot'").count()
    assert n_hot * 3 >= cpu.count() * 0.9            # about a third of all rows on one key
    t0 = time.time()
    ours = cpu_mem_alerts(cpu, mem).select(
        "server_id", "window_start", F.col("avg_cpu").alias("x"), F.col("avg_mem").alias("y"))
    got = ours.collect()
    took = time.time() - t0
    lit = _literal_range_join(spark, cpu, mem, CPU_MEM_JOB).select(
        "server_id", F.date_format(F.timestamp_seconds(F.col("w") * 10), "HH:mm:ss").alias("window_start"),
        "x", "y")
    assert len(got) == lit.count()
    assert ours.exceptAll(lit).count() == 0 and lit.exceptAll(ours).count() == 0
    hot_rows = [r for r in got if r.server_id == "srv-hot" and r.x is not None]
    assert len(hot_rows) == 1                       # one timestamp -> one non-empty window start 00:00:00
    assert took < 120
