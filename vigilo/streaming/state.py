"""State of a windowed alert stream: partials of keys in files, and the watermark.

A micro-batch is reduced to partials of its keys (``operators.pairing``), written as one segment. The watermark is the
slower feed's newest time less the delay. When a batch moves it, the windows that it passed are computed from the
segments that reach into them, by the batch job's own steps, and are final: each is emitted once. Rows at or before the
watermark of the batch before are late; they are dropped and counted. All of it is aggregation over files, so what a task
holds is bounded (Spark spills), no key is looked up by itself, and a restart loads nothing.

An entry a batch, a small JSON file that appears by one rename, has the newest times, the watermark, the count of late
rows and the segments that windows to come reach into. A batch is computed from the entry of the batch before it, so one that
is repeated after a failure replaces itself. Segments and entries that no batch to come reads are deleted as the next
batch begins, and many small segments become one, so the state is as large as the watermark's delay makes it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import PairJobSpec
from ..operators.pairing import merge_partials, on_both_sides, side_partials
from ..plans.alert_jobs import windows_of_keys
from ..session import write_folders
from ..sources.commits import _Files

MERGE_AFTER = 32          # segments that are kept as they are
SECOND = 1_000_000        # times are microseconds since the epoch
WINDOWS = "server_id string, w long, x_a {x}, x_b {x}, _lo long"
NOTHING = {"newest": [None, None], "watermark": None, "late": 0, "segments": []}


def delay_us(spark: SparkSession, watermark: str) -> int:
    """An interval's text (``"5 minutes"``) in microseconds."""
    delay = spark.sql(f"SELECT unix_micros(timestamp_seconds(0) + INTERVAL '{watermark}')").first()[0]
    if delay < 0:
        raise ValueError(f"the watermark's delay can't be negative: {watermark}")
    return delay


def _time(us: int) -> Column:
    return F.timestamp_micros(F.lit(us).cast("long"))


class WindowState:
    """Keys of one stream whose windows aren't final, at a path in shared storage. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, job: PairJobSpec, delay: int = 0, merge_after: int = MERGE_AFTER):
        self.spark, self.path, self.job, self.delay, self.merge_after = spark, path.rstrip("/"), job, delay, merge_after
        self.length = job.window.validate().length_s * SECOND
        self._files = _Files(spark, self.path)

    # -------------------------------------------------------------- entries

    def _names(self, before: int | None = None) -> list[str]:
        return [n for n in self._files.names("log") if before is None or int(n.split(".")[0]) < before]

    def _entry(self, before: int | None = None) -> dict:
        """The last attempt at the last batch, or at the last one before a batch."""
        names = self._names(before)
        return json.loads(self._files.read(f"log/{names[-1]}")) if names else NOTHING

    def late_rows(self) -> int:
        """Rows that were dropped as later than the watermark allows, in all batches."""
        return self._entry()["late"]

    def watermark(self) -> int | None:
        return self._entry()["watermark"]

    def _commit(self, entry: dict, batch: int) -> None:
        attempts = sum(int(n.split(".")[0]) == batch for n in self._files.names("log"))
        self._files.write("log", f"{batch:012d}.{attempts:04d}.json", json.dumps(entry))

    def _clean(self, batch: int, was: dict) -> None:
        """Delete what only batches before the last one read, and what an attempt at this batch has left."""
        held = {s["folder"] for s in was["segments"]}
        for name in self._files.names("data"):
            if f"data/{name}" not in held:
                self._files.delete(f"data/{name}")
        for name in self._names(batch)[:-1]:
            self._files.delete(f"log/{name}")

    # -------------------------------------------------------------- segments

    def _write(self, partials: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        write_folders(partials, f"{self.path}/{folder}")
        return folder

    def _keys(self, segments: list[dict], after: int | None, before: int | None = None) -> DataFrame:
        """Partials of the keys after one time and before another."""
        rows = self.spark.read.parquet(*[f"{self.path}/{s['folder']}" for s in segments])
        if after is not None:
            rows = rows.where(F.col("ts") > _time(after))
        if before is not None:
            rows = rows.where(F.col("ts") < _time(before))
        # a segment has a row a key, and segments of different times have no key in common
        order = sorted(segments, key=lambda s: s["lo"])
        apart = all(x["hi"] < y["lo"] for x, y in zip(order, order[1:]))
        return rows if apart else merge_partials(rows, self.job.how)

    def _final(self, segments: list[dict], was: int | None, now: int) -> DataFrame:
        """The windows that end after one watermark and not after the next."""
        after = None if was is None else was - self.length
        held = [s for s in segments if s["lo"] < now and (after is None or s["hi"] > after)]
        if not held:
            return self._no_windows()
        windows = windows_of_keys(on_both_sides(self._keys(held, after, now)), self.job)
        end = F.col("w") * (self.job.window.slide_s * SECOND) + self.length
        passed = end <= now if was is None else (end > was) & (end <= now)
        return windows.where(passed).select("server_id", "w", "x_a", "x_b", "_lo")

    def _no_windows(self) -> DataFrame:
        return self.spark.createDataFrame([], WINDOWS.format(x="double" if self.job.how == "avg" else "float"))

    # -------------------------------------------------------------- batches

    def take(self, rows: DataFrame, batch: int, emit: Callable[[DataFrame], None]) -> None:
        """A micro-batch of ``both_sides``. ``emit`` is given the windows that it makes final, and must have committed them when it returns."""
        was = self._entry(batch)
        self._clean(batch, was)
        mark, us = was["watermark"], F.unix_micros("ts")
        late = F.lit(False) if mark is None else us <= mark
        seen = Observation()          # of keys, which are fewer than rows
        keys = side_partials(rows, self.job.how).observe(
            seen, F.max(F.when(F.col("a_n") > 0, us)).alias("newest 0"), F.max(F.when(F.col("b_n") > 0, us)).alias("newest 1"),
            F.min(F.when(~late, us)).alias("lo"), F.sum(F.when(late, F.col("a_n") + F.col("b_n"))).alias("late"))
        folder = self._write(keys.where(~late))
        n = seen.get
        newest = [max((x for x in (old, n.get(f"newest {i}")) if x is not None), default=None) for i, old in enumerate(was["newest"])]
        segments = list(was["segments"])
        if n.get("lo") is not None:
            segments.append({"folder": folder, "lo": n["lo"], "hi": max(x for x in (n["newest 0"], n["newest 1"]) if x is not None)})
        now = mark
        if None not in newest:
            now = min(newest) // 1000 * 1000 - self.delay        # whole milliseconds, as Spark's own watermarks
            now = now if mark is None else max(mark, now)
        emit(self._no_windows() if now == mark else self._final(segments, mark, now))
        if now is not None:
            segments = [s for s in segments if s["hi"] > now - self.length]
        if len(segments) > self.merge_after:
            merged = self._write(self._keys(segments, None if now is None else now - self.length))
            segments = [{"folder": merged, "lo": min(s["lo"] for s in segments), "hi": max(s["hi"] for s in segments)}]
        self._commit({"newest": newest, "watermark": now, "late": was["late"] + (n.get("late") or 0), "segments": segments}, batch)
