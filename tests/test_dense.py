"""The live dense sink against the batch job's dense table, batch by batch."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigilo.config import CPU_MEM_JOB, NET_DISK_JOB
from vigilo.operators.windows import densify
from vigilo.plans.alert_jobs import pair_alerts, windowed_stats
from vigilo.plans.stream_jobs import dense_run
from vigilo.session import stage
from vigilo.sources.telemetry import load_metrics
from vigilo.streaming.dense import DenseSink
from vigilo.streaming.windows import HEARTBEAT_SERVER

WINDOWS = "server_id string, w long, x_a double, x_b double, _lo long"


def same(a, b):
    columns = a.columns
    return a.exceptAll(b.select(columns)).count() == 0 and b.select(columns).exceptAll(a).count() == 0


def made(spark):
    """Non-empty windows in which one server starts late, one stops early, and nobody sends for a while."""
    starts = {"early": [*range(98, 110), *range(140, 143)], "late": [*range(120, 130), *range(150, 153)], "brief": range(98, 104)}
    return spark.createDataFrame([(s, w, w / 2, 1.0 if w % 3 else None, max(w, 100)) for s, ws in starts.items() for w in ws], WINDOWS)


def test_after_each_batch_the_sink_is_the_dense_table_up_to_the_frontier(spark, tmp_dir):
    windows = stage(made(spark), "windows")
    whole = densify(windows, 4).select("server_id", "w", "x_a", "x_b").collect()
    sink = DenseSink(spark, tmp_dir, CPU_MEM_JOB, compact_every=3)
    cuts = [0, 101, 101, 106, 121, 122, 145, 151, 200]
    for batch, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        mine = windows.where(f"w >= {lo} and w < {hi}")
        beat = spark.createDataFrame([(HEARTBEAT_SERVER, 10 ** 6, None, None, 10 ** 6)], WINDOWS)
        sink.take(mine.union(beat), batch)
        if batch in (0, 3):
            sink.take(mine.union(beat), batch)                       # a batch repeated after a failure
        final = windows.where(f"w < {hi}")
        upto, seen = final.agg(F.max("w")).first()[0], {r.server_id for r in final.select("server_id").collect()}
        expected = sorted(((r.server_id, r.w, r.x_a, r.x_b) for r in whole if r.w <= upto and r.server_id in seen), key=str)
        assert sorted((tuple(r) for r in sink.rows.read().select("server_id", "w", "x_a", "x_b").collect()), key=str) == expected
    assert len(expected) == len(whole)


def test_nothing_but_empty_batches(spark, tmp_dir):
    sink = DenseSink(spark, tmp_dir, NET_DISK_JOB)
    for batch in range(2):
        sink.take(spark.createDataFrame([], WINDOWS), batch)
    assert sink.alerts().count() == 0
    sink.take(spark.createDataFrame([("s", 7, 1.0, 2.0, 7), ("s", 6, 1.0, 2.0, 7)], WINDOWS), 2)     # 6 is a warm-up window
    assert [(r.server_id, r.window_start) for r in sink.alerts().collect()] == [("s", "00:01:10")]


def test_interrupted_batch_is_taken_again(spark, tmp_dir, monkeypatch):
    windows = stage(made(spark), "windows")
    sink = DenseSink(spark, tmp_dir, CPU_MEM_JOB)
    sink.take(windows.where("w < 105"), 0)
    monkeypatch.setattr(sink.state, "commit", lambda *a: (_ for _ in ()).throw(IOError("lost")))
    with pytest.raises(IOError):
        sink.take(windows.where("w between 105 and 125"), 1)
    again = DenseSink(spark, tmp_dir, CPU_MEM_JOB)
    again.take(windows.where("w between 105 and 125"), 1)
    again.take(windows.where("w > 125"), 2)
    assert same(again.rows.read(), densify(windows, 4))


def test_dense_stream_equals_batch(spark):
    m = load_metrics(spark, SF_SMALL)
    assert same(dense_run(spark, m["cpu"], m["mem"], CPU_MEM_JOB), pair_alerts(m["cpu"], m["mem"], CPU_MEM_JOB))
    assert windowed_stats(m["cpu"], m["mem"], CPU_MEM_JOB).count() > 0
