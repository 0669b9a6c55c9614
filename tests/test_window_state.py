"""Keys of a windowed stream wait in files: final windows batch by batch, repeated batches, late rows, how large the state is."""

import pytest
from pyspark.sql import functions as F

from vigilo.config import CPU_MEM_JOB, NET_DISK_JOB
from vigilo.operators.pairing import both_sides
from vigilo.plans.alert_jobs import load_rounded, windowed_stats
from vigilo.streaming.state import SECOND, WindowState, delay_us
from vigilo.streaming.windows import HEARTBEAT_SERVER, late_rows, read_windowed, start_windowed_alerts

T0 = 1704067200
MINUTE = 60 * SECOND


def feed(spark, column, seconds, servers=("a", "b")):
    """A sample a second and server, each fifth twice, each seventh without a value, each ninth from nobody."""
    rows = [(T0 + s, None if s % 9 == 0 and k else x, None if s % 7 == 0 else s % 50 + k / 4)
            for s in seconds for x in servers for k in range(2 if s % 5 == 0 else 1)]
    return spark.createDataFrame(rows, f"s long, server_id string, {column} float").select(F.timestamp_seconds("s").alias("ts"), "server_id", column)


def feeds(spark, job, seconds, of_b=None):
    return feed(spark, job.first.column, seconds), feed(spark, job.second.column, seconds if of_b is None else of_b)


def sides(a, b, job):
    fa, fb = job.first.column, job.second.column
    return both_sides(load_rounded(a, fa), fa, load_rounded(b, fb), fb)


def listed(windows):
    return sorted((r.server_id, r.w, r.x_a, r.x_b, r._lo) for r in windows.select("server_id", "w", "x_a", "x_b", "_lo").collect())


@pytest.mark.parametrize("job", [CPU_MEM_JOB, NET_DISK_JOB], ids=lambda j: j.label)
def test_final_windows_batch_by_batch(spark, tmp_dir, job):
    state = WindowState(spark, f"{tmp_dir}/state", job, MINUTE, merge_after=2)
    # seconds of both feeds; the second batch goes back, within the delay, the third has one feed only, and b is slower than a
    batches = [(range(0, 100), range(0, 90)), (range(60, 180), range(60, 170)), (range(180, 200), []), ([], range(170, 240)),
               (range(200, 330), range(240, 300)), ([4000], [4000])]
    got, seen_a, seen_b = {}, [], []
    for n, (in_a, in_b) in enumerate(batches):
        rows = sides(*feeds(spark, job, in_a, in_b), job)
        state.take(rows, n, lambda w: got.__setitem__(n, listed(w)))
        if n in (1, 4):
            first, entry = got.pop(n), state._entry()
            state.take(rows, n, lambda w: got.__setitem__(n, listed(w)))               # repeated after a failure
            plain = lambda e: {**e, "segments": [(s["lo"], s["hi"]) for s in e["segments"]]}
            assert got[n] == first and plain(state._entry()) == plain(entry)
        seen_a, seen_b = [*seen_a, *in_a], [*seen_b, *in_b]
        mark = (min(max(seen_a), max(seen_b)) + T0) * SECOND - MINUTE
        assert state.watermark() == mark
        whole = windowed_stats(*feeds(spark, job, seen_a, seen_b), job).where(F.col("w") * 10 * SECOND + 30 * SECOND <= mark)
        assert sorted(x for b in got.values() for x in b) == listed(whole)
    assert got[5] and state.late_rows() == 0


def test_late_rows_are_dropped_and_counted(spark, tmp_dir):
    state, got = WindowState(spark, f"{tmp_dir}/state", CPU_MEM_JOB, MINUTE), []
    take = lambda n, a, b: state.take(sides(*feeds(spark, CPU_MEM_JOB, a, b), CPU_MEM_JOB), n, lambda w: got.append(listed(w)))
    take(0, range(0, 181), range(0, 181))                                              # the watermark: second 120
    assert got[0] and max(w for _, w, *_ in got[0]) * 10 + 30 == T0 + 120
    take(1, [121], [121])                                                              # behind the newest, but not late
    assert state.late_rows() == 0 and got[1] == []
    take(2, [119, 120], [121])                                                         # 120 is there twice a server, one of each two of them
    assert state.late_rows() == sum(r.server_id is not None for r in feed(spark, "x", [119, 120]).collect()) and got[2] == []
    take(3, [], [])
    assert got[3] == [] and state.late_rows() > 0
    take(4, [4000], [4000])
    on_time = feeds(spark, CPU_MEM_JOB, [*range(0, 181), 121], [*range(0, 181), 121, 121])
    assert sorted(x for b in got for x in b) == listed(windowed_stats(*on_time, CPU_MEM_JOB).where(f"w < {(T0 + 3000) // 10}"))


def test_state_is_as_large_as_the_delay(spark, tmp_dir):
    state, kept = WindowState(spark, f"{tmp_dir}/state", CPU_MEM_JOB, MINUTE, merge_after=3), []
    for n in range(9):
        state.take(sides(*feeds(spark, CPU_MEM_JOB, range(30 * n, 30 * n + 30)), CPU_MEM_JOB), n, lambda w: w.count())
        segments = state._entry()["segments"]
        kept.append(spark.read.parquet(*[f"{tmp_dir}/state/{s['folder']}" for s in segments]).count())
        assert len(segments) <= 3 and len(state._files.names("log")) <= 2
    assert max(kept) <= 2 * (60 + 30 + 30) and min(kept[4:]) >= 2 * 60                 # a delay, a window and a batch of two servers
    state.take(sides(*feeds(spark, CPU_MEM_JOB, [9000]), CPU_MEM_JOB), 9, lambda w: w.count())
    state.take(sides(*feeds(spark, CPU_MEM_JOB, [9001]), CPU_MEM_JOB), 10, lambda w: w.count())
    assert len(state._files.names("data")) == len(state._entry()["segments"]) == 2


def test_stream_keeps_no_state_in_memory(spark, tmp_dir):
    for batch in (range(0, 200), range(200, 400), [4000]):
        for k, df in zip("ab", feeds(spark, CPU_MEM_JOB, batch)):
            df = df if len(batch) > 1 else df.withColumn("server_id", F.lit(HEARTBEAT_SERVER))
            df.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/{k}")
        q = start_windowed_alerts(*(spark.readStream.schema(spark.read.parquet(f"{tmp_dir}/{k}").schema).parquet(f"{tmp_dir}/{k}") for k in "ab"),
                                  CPU_MEM_JOB, f"{tmp_dir}/out", f"{tmp_dir}/checkpoint", available_now=True)
        q.awaitTermination()
        assert q.recentProgress and all(not p["stateOperators"] for p in q.recentProgress)
    assert late_rows(spark, f"{tmp_dir}/checkpoint", CPU_MEM_JOB) == 0
    assert listed(read_windowed(spark, f"{tmp_dir}/out")) == listed(windowed_stats(*feeds(spark, CPU_MEM_JOB, range(0, 400)), CPU_MEM_JOB))


def test_checkpoint_of_an_earlier_version_is_refused(spark, tmp_dir):
    spark.range(1).write.parquet(f"{tmp_dir}/checkpoint/state/0")
    a, b = (spark.readStream.schema(df.schema).parquet(tmp_dir) for df in feeds(spark, CPU_MEM_JOB, [0]))
    with pytest.raises(ValueError, match="earlier version"):
        start_windowed_alerts(a, b, CPU_MEM_JOB, f"{tmp_dir}/out", f"{tmp_dir}/checkpoint", available_now=True)


def test_delay(spark):
    assert delay_us(spark, "5 minutes") == 5 * MINUTE and delay_us(spark, "1 hour 500 milliseconds") == 60 * MINUTE + SECOND // 2
    with pytest.raises(ValueError):
        delay_us(spark, "-1 second")
