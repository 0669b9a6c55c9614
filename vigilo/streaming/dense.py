"""Dense windows of a live stream.

The windowed stream (``streaming.windows``) emits a window once the watermark has passed its end, and
only where it holds rows. A `DenseSink` adds the empty ones as the stream goes on: every server has a row
for every window from the first aligned start up to the newest final window, the frontier, which is the same
for all servers because the watermark is. A batch moves the frontier; servers known before get the windows
that it passed, servers seen for the first time all windows from the first start. Rows are written once and
never corrected, and the whole table is never read or rewritten for a batch.

What a batch adds to the state is the servers that it saw first and one row with the bounds. Windows, rows
and state are committed tables, state last, and a batch is computed from the state of earlier batches, so
a batch that is repeated after a failure replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import PairJobSpec
from ..operators.windows import spine
from ..plans.alert_jobs import finish
from ..sources.commits import COMPACT_EVERY, CommittedTable
from .windows import HEARTBEAT_SERVER, start_final_windows


class DenseSink:
    """Dense final windows of one alert job, at a path in shared storage, written by one stream."""

    def __init__(self, spark: SparkSession, path: str, job: PairJobSpec, compact_every: int = COMPACT_EVERY):
        self.spark, self.job = spark, job
        self.emitted = CommittedTable(spark, f"{path}/emitted", (), None, compact_every)
        self.rows = CommittedTable(spark, f"{path}/rows", (), None, compact_every)
        self.state = CommittedTable(spark, f"{path}/state", (), None, compact_every)

    def _before(self, batch: int) -> DataFrame:
        """State of earlier batches: servers, and rows without a server that carry the bounds ``lo`` and ``upto``."""
        if batch == 0 or self.state.schema() is None:
            return self.spark.createDataFrame([], "server_id string, lo long, upto long")
        return self.state.read(upto=batch - 1)

    def take(self, windows: DataFrame, batch: int, run: str = "all") -> None:
        """Final windows of a batch (``server_id, w, x_a, x_b, _lo``); those of the heartbeat server count for nothing."""
        if self.state.is_merged(batch, run):
            return
        # the batch is read several times: from what is committed, not from the stream's state
        now = self.emitted.read_folder(self.emitted.commit(windows.where(F.col("server_id") != HEARTBEAT_SERVER), batch, run))
        before = self._before(batch)
        was = before.agg(F.min("lo").alias("lo"), F.max("upto").alias("upto")).first()
        seen = now.agg(F.min("_lo").alias("lo"), F.max("w").alias("upto")).first()
        lo = min((x for x in (was.lo, seen.lo) if x is not None), default=None)
        upto = max((x for x in (was.upto, seen.upto) if x is not None), default=None)
        known = before.where("server_id is not null").select("server_id")
        new = now.select("server_id").distinct().join(known, "server_id", "left_anti")
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        grid = self.spark.createDataFrame([], "server_id string, w long")
        for servers, first in ((known, None if was.upto is None else was.upto + 1), (new, lo)):
            if first is not None and first <= upto:
                extent = servers.select("server_id", F.lit(first).cast("long").alias("lo"), F.lit(upto).cast("long").alias("hi"))
                grid = grid.union(spine(extent, tasks))
        self.rows.commit(grid.join(now, ["server_id", "w"], "left").select("server_id", "w", "x_a", "x_b"), batch, run)
        bounds = self.spark.createDataFrame([(None, lo, upto)], "server_id string, lo long, upto long")
        none = F.lit(None).cast("long")
        self.state.commit(bounds.union(new.select("server_id", none, none)), batch, run)

    def alerts(self, sort: bool = True) -> DataFrame:
        """The result table up to the newest final window: the batch job's rows of those windows."""
        return finish(self.rows.read(), self.job, dense=False, sort=sort)


def start_dense_alerts(first: DataFrame, second: DataFrame, job: PairJobSpec, path: str, checkpoint: str, watermark: str = "60 seconds",
                       available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Append dense final windows of two metric streams to the sink at a path.

    Rows later than the watermark allows are dropped and counted (``late_rows``), as in ``start_windowed_alerts``. Where no
    server sends rows the frontier stands still; the windows of such a pause follow with the first window after it.
    """
    return start_final_windows(
        first, second, job, checkpoint, watermark,
        lambda windows, batch, run: DenseSink(windows.sparkSession, path, job).take(windows, batch, run), available_now, processing_time)
