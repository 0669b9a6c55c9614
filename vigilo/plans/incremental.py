"""The windowed alert table kept up to date batch by batch.

An `AlertStore` holds mergeable partials of every key (rows, non-null rows, sum or maximum, by side) and the
windows computed from them, both as committed tables. A batch of new rows is reduced to partials and
committed; only the windows that its keys lie in are computed again, from the partials of their blocks of
time, and committed as newer rows of the same windows. Input files are read once, partials only in the
hours and for the servers that a batch touches. Rows may come in any order, so late ones need nothing
special: their windows are corrected. The result is the batch job's, after every batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import PairJobSpec
from ..operators.pairing import key_partials, merge_partials, on_both_sides
from ..sources.commits import COMPACT_EVERY, CommittedTable
from .alert_jobs import finish, load_rounded, windows_of_keys

HOUR_S = 3600
MOST_HOURS = 2000         # hours named in a filter on the partials; a batch of more reads all of them


def _hour(seconds) -> F.Column:
    return F.floor(seconds / HOUR_S).cast("long")


def _newest(windows: DataFrame) -> DataFrame:
    order = Window.partitionBy("server_id", "w").orderBy(F.desc("seq"))
    return windows.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


class AlertStore:
    """Partials, windows and late rows of one alert job, at a path in shared storage. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, job: PairJobSpec, compact_every: int = COMPACT_EVERY):
        self.spark, self.job = spark, job
        self.spec = job.window.validate()
        self.partials = CommittedTable(spark, f"{path}/partials", ("hour",), self._merged_keys, compact_every)
        self.windows = CommittedTable(spark, f"{path}/windows", (), _newest, compact_every)
        self.late = CommittedTable(spark, f"{path}/late", (), None, compact_every)
        self.frontier = CommittedTable(spark, f"{path}/frontier", (), None, compact_every)

    def _merged_keys(self, partials: DataFrame) -> DataFrame:
        return merge_partials(partials, self.job.how, F.max("hour").alias("hour")).select(*partials.columns)

    def _block(self):
        return F.floor(F.unix_seconds("ts") / self.spec.length_s).cast("long")

    def add(self, first: DataFrame, second: DataFrame, batch: int, run: str = "all") -> None:
        """Take in a batch of rows of both feeds (``ts, server_id`` and the value). A batch that is given again replaces itself."""
        if self.partials.is_merged(batch, run):
            return
        fa, fb = self.job.first.column, self.job.second.column
        new = key_partials(load_rounded(first, fa), fa, load_rounded(second, fb), fb, self.job.how)
        folder = self.partials.commit(new.withColumn("hour", _hour(F.unix_seconds("ts"))), batch, run)
        changed = self._computed_again(self.partials.read_folder(folder), folder).withColumn("seq", F.lit(batch).cast("long"))
        self.windows.commit(changed, batch, run)

    def _computed_again(self, new: DataFrame, folder: str | None = None) -> DataFrame:
        """The windows that hold a key of the new partials, from all partials of their blocks of time.

        folder: that of the new partials, by default the last. Partials are dealt once, by server and block: the semi-join, the
        merge of their keys and the sums of their buckets need no more, and the new ones are known by their folder.
        """
        folders = self.partials.folders()
        folder = folder or folders[-1]
        # a window of a key lies in the block of the key's time (blocks are as long as windows) or a neighbouring one
        blocks = new.select("server_id", F.explode(F.array(self._block() - 1, self._block(), self._block() + 1)).alias("_block")).distinct()
        held = self.partials.read_marked(folder)
        reach = -(-2 * self.spec.length_s // HOUR_S)
        hours = [r.hour for r in new.select("hour").distinct().limit(MOST_HOURS + 1).collect()]
        if len(hours) <= MOST_HOURS:
            held = held.where(F.col("hour").isin(sorted({h + k for h in hours for k in range(-reach, reach + 1)})))
        held = held.withColumn("_block", self._block())
        if folders == [folder]:
            held = held.repartition("server_id", "_block")          # nothing but the new ones
        else:
            held = held.join(blocks, ["server_id", "_block"], "left_semi")
        keys = on_both_sides(merge_partials(held, self.job.how, F.max("_new").alias("_new"), dealt_by=("_block",))).drop("_block")
        return windows_of_keys(keys, self.job, ("_new",)).where("_new = 1").drop("_new")

    def current(self) -> DataFrame:
        """The newest state of every non-empty window: ``server_id, w, x_a, x_b, _lo``."""
        return _newest(self.windows.read()).drop("seq")

    def alerts(self, dense: bool = True, sort: bool = True) -> DataFrame:
        """The result table, as the batch job gives it for all rows taken in so far."""
        return finish(self.current(), self.job, dense=dense, sort=sort)

    # -------------------------------------------------------------- streams

    def take(self, rows: DataFrame, batch: int, run: str, delay_s: int) -> None:
        """A micro-batch of rows tagged by side; those more than delay_s behind the newest earlier row are noted as late, too."""
        if self.frontier.is_merged(batch, run):
            return
        so_far = self._newest_second(batch, run)
        if so_far is not None:
            self.late.commit(rows.where(F.unix_seconds("ts") < so_far - delay_s), batch, run)
        sides = [rows.where(F.col("side") == i).select("ts", "server_id", F.col("value").alias(m.column))
                 for i, m in enumerate((self.job.first, self.job.second))]
        self.add(*sides, batch, run)
        self.frontier.commit(rows.agg(F.max(F.unix_seconds("ts")).alias("newest"), F.count("*").alias("rows")), batch, run)

    def _newest_second(self, batch: int, run: str) -> int | None:
        if batch == 0 or self.frontier.schema() is None:
            return None
        return self.frontier.read(upto=batch - 1).agg(F.max("newest").alias("s")).first().s


def tagged(first: DataFrame, second: DataFrame, job: PairJobSpec) -> DataFrame:
    """Two feeds, streams or not, as one: ``side, ts, server_id, value``."""
    return (first.select(F.lit(0).alias("side"), "ts", "server_id", F.col(job.first.column).cast("float").alias("value"))
            .unionByName(second.select(F.lit(1).alias("side"), "ts", "server_id", F.col(job.second.column).cast("float").alias("value"))))


def start_corrected_alerts(first: DataFrame, second: DataFrame, job: PairJobSpec, path: str, checkpoint: str, delay_s: int = 60,
                           available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Keep the store at a path up to date with two metric streams, whatever order their rows come in.

    Windows are there as soon as their rows are, and are corrected when more come. Nothing is dropped: rows that come more
    than delay_s of event time behind are listed in the store's `late` table and their windows computed again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        AlertStore(batch.sparkSession, path, job).take(batch, batch_id, run, delay_s)

    w = tagged(first, second, job).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def in_batches(spark: SparkSession, first: DataFrame, second: DataFrame, job: PairJobSpec, path: str, batches: int = 3) -> DataFrame:
    """Both feeds taken in in several batches that share keys, by a hash of the rows; the result table after the last."""
    store = AlertStore(spark, path, job)
    for i in range(batches):
        mine = [f.where(F.pmod(F.xxhash64("ts", "server_id", m.column), F.lit(batches)) == i) for f, m in zip((first, second), (job.first, job.second))]
        store.add(*mine, i)
    return store.alerts()
