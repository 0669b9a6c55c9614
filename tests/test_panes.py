"""Sliding aggregates over panes against the literal join, for few and many windows a sample and odd geometries."""

import random
from collections import defaultdict
from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from vigilo.config import CPU_MEM_JOB, NET_DISK_JOB, WindowSpec
from vigilo.operators.pairing import pair_stats
from vigilo.plans.alert_jobs import load_rounded, pair_alerts, windows_of_keys
from vigilo.schemas import CPU_TABLE, DISK_TABLE, MEM_TABLE, metric_table

T0 = datetime(2024, 1, 1)
EPOCH = 1704067200


def feed(seed, n=160):
    """Samples on few keys, repeated keys, long holes, empty values, a server in one feed only."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        second = rng.choice((rng.randint(0, 90), rng.randint(400, 470), 5000 + rng.randint(0, 40)))
        out.append((T0 + timedelta(seconds=second), rng.choice(("a", "b")), rng.choice((None, round(rng.random() * 100, 2), 50.0))))
    return out + [(T0, f"only-{seed}", 1.0), (None, "a", 2.0), (T0, None, 3.0)]


def literal(a, b, spec, how):
    """Pairs, then every window of each pair."""
    held = defaultdict(lambda: ([], []))
    for ta, sa, x in a:
        for tb, sb, y in b:
            if ta is not None and sa is not None and ta == tb and sa == sb:
                second = EPOCH + int((ta - T0).total_seconds())
                w = second // spec.slide_s
                while w * spec.slide_s + spec.length_s > second:
                    held[sa, w][0].append(x)
                    held[sa, w][1].append(y)
                    w -= 1
    def value(xs):
        xs = [x for x in xs if x is not None]
        return None if not xs else sum(xs) / len(xs) if how == "avg" else max(xs)
    return {k: tuple(map(value, v)) for k, v in held.items()}


@pytest.mark.parametrize("length, slide", [(10, 10), (30, 10), (360, 1), (3600, 10), (45, 10), (50, 20), (7, 2), (61, 60)])
@pytest.mark.parametrize("job, second", [(CPU_MEM_JOB, MEM_TABLE), (NET_DISK_JOB, DISK_TABLE)])
def test_equals_the_literal_join(spark, job, second, length, slide):
    spec = WindowSpec(length, slide)
    job = replace(job, window=spec)
    a, b = feed(1), feed(2)
    first = CPU_TABLE if job.how == "avg" else metric_table("net_in")
    fa, fb = spark.createDataFrame(a, first), spark.createDataFrame(b, second)
    stats = pair_stats(load_rounded(fa, job.first.column), job.first.column, load_rounded(fb, job.second.column), job.second.column, job.how)
    got = windows_of_keys(stats, job, expand=0).collect()
    want = literal(a, b, spec, job.how)
    assert {(r.server_id, r.w) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        for x, y in zip((r.x_a, r.x_b), want[r.server_id, r.w]):
            assert x is y is None or x == pytest.approx(y, rel=1e-6)
    starts = {s: min(w for t, w in want if t == s) for s, _ in want}
    n = -(-length // slide)
    assert all(starts[r.server_id] <= r._lo for r in got) and all(r.w <= r._lo <= r.w + n for r in got)


def test_panes_and_repeated_buckets_agree(spark):
    a, b = spark.createDataFrame(feed(3), CPU_TABLE), spark.createDataFrame(feed(4), MEM_TABLE)
    stats = pair_stats(load_rounded(a, "cpu_pct"), "cpu_pct", load_rounded(b, "mem_pct"), "mem_pct", "avg")
    one, two = ({(r.server_id, r.w, r._lo): (r.x_a, r.x_b) for r in windows_of_keys(stats, CPU_MEM_JOB, expand=e).collect()} for e in (0, 8))
    assert set(one) == set(two)
    assert all(x is y is None or x == pytest.approx(y) for k in one for x, y in zip(one[k], two[k]))


def test_rows_are_not_repeated_for_their_windows(spark):
    """One hour every ten seconds: no plan node makes 360 rows of one."""
    a, b = spark.createDataFrame(feed(5), CPU_TABLE), spark.createDataFrame(feed(6), MEM_TABLE)
    job = replace(CPU_MEM_JOB, window=WindowSpec(3600, 10))
    stats = pair_stats(load_rounded(a, "cpu_pct"), "cpu_pct", load_rounded(b, "mem_pct"), "mem_pct", "avg")
    plan = windows_of_keys(stats, job)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode(sequence(") == 2 and "_chunk" in plan            # the grid's only: chunks, and their panes


def test_dense_long_windows(spark):
    a, b = spark.createDataFrame(feed(7), CPU_TABLE), spark.createDataFrame(feed(8), MEM_TABLE)
    got = pair_alerts(a, b, replace(CPU_MEM_JOB, window=WindowSpec(3600, 10))).collect()
    assert len(got) == 2 * len({r.window_start for r in got}) and got == sorted(got, key=lambda r: (r.server_id, r.window_start))
    assert pair_alerts(a.limit(0), b, replace(CPU_MEM_JOB, window=WindowSpec(3600, 10))).count() == 0
