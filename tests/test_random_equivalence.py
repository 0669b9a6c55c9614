"""Random inputs with duplicate keys, NULL keys and values and NaN: the weighted plan equals
the literal pair join + range join for both jobs."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vigilo.config import CPU_MEM_JOB, NET_DISK_JOB
from vigilo.plans.alert_jobs import pair_alerts
from vigilo.schemas import metric_table
from test_windows import _literal_range_join

BASE = datetime(2024, 1, 1, 0, 0, 0)


def _rows(rng, n, servers, span):
    out = []
    for _ in range(n):
        ts = None if rng.random() < 0.03 else BASE + timedelta(seconds=rng.randrange(span),
                                                              microseconds=rng.choice([0, 0, 250000]))
        srv = None if rng.random() < 0.03 else f"s{rng.randrange(servers)}"
        r = rng.random()
        v = None if r < 0.05 else (math.nan if r < 0.07 else round(rng.uniform(70, 100), 3))
        out.append((ts, srv, v))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("job", [CPU_MEM_JOB, NET_DISK_JOB], ids=["avg", "max"])
def test_random_equivalence(spark, seed, job):
    rng = random.Random(seed)
    fa, fb = job.first.column, job.second.column
    a = spark.createDataFrame(_rows(rng, 400, 4, 120), metric_table(fa))
    b = spark.createDataFrame(_rows(rng, 400, 4, 120), metric_table(fb))
    ours = pair_alerts(a, b, job).select("server_id", "window_start",
                                         F.col(job.out_first).alias("x"), F.col(job.out_second).alias("y"))
    lit = _literal_range_join(spark, a, b, job).select(
        "server_id", F.date_format(F.timestamp_seconds(F.col("w") * 10), "HH:mm:ss").alias("window_start"),
        "x", "y")
    assert ours.count() == lit.count() > 0
    assert ours.exceptAll(lit).count() == 0 and lit.exceptAll(ours).count() == 0
