"""Topics as committed tables of messages with offsets, and what each consumer group has taken of them.

Offsets of a topic begin at 0, have no gaps and go on with each publication. They are a distributed prefix
sum: each task writes its rows of a topic to a file of their own, where a row's place is its number, the
files' counts are added up per topic (a row a file), and the sum before a file is the base of its rows; no
task numbers a topic's rows alone, and no message is shuffled or sorted. A group's
position is a row a topic in the ledger; a group without one begins at offset 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, stage, write_folders
from .commits import COMPACT_EVERY, CommittedTable

OPEN_TOPICS = 64          # files that a publishing task keeps open
MESSAGE_COLUMNS = ("topic", "value", "offset", "timestamp")


class TopicLog:
    """Messages of all topics at a path. One publisher at a time; readers may read meanwhile."""

    def __init__(self, spark: SparkSession, path: str, compact_every: int = COMPACT_EVERY):
        self.spark = spark
        self.messages = CommittedTable(spark, f"{path}/messages", ("topic",), None, compact_every)
        self.ends = CommittedTable(spark, f"{path}/ends", (), lambda e: e.groupBy("topic").agg(F.max("end").alias("end")), compact_every)
        self.ledger = CommittedTable(spark, f"{path}/ledger", (), _latest, compact_every)

    @staticmethod
    def _next(table: CommittedTable) -> int:
        entries = table.entries()
        merged = [m["batch"] for run in table.runs() for m in table._state(run)[0]]
        return 1 + max([-1, *merged, *(e["batch"] for e in entries)])

    # -------------------------------------------------------------- publishing

    def end_offsets(self) -> dict[str, int]:
        """The offset after each topic's last message."""
        if self.ends.schema() is None:
            return {}
        return {r.topic: r.end for r in self.ends.read().groupBy("topic").agg(F.max("end").alias("end")).collect()}

    def publish(self, messages: DataFrame) -> dict[str, int]:
        """Append ``topic, value`` rows, each with its topic's next offset; returns the topics' new ends.

        Rows without a topic are left out. The order within a publication is that of the frame's tasks and their rows (of a
        task's first OPEN_TOPICS topics; it may write rows of more in another order).
        """
        path = scratch_path(self.spark, "published")
        rows = (messages.where(F.col("topic").isNotNull()).select(
            "topic", F.col("value").cast("string").alias("value"),
            (F.col("timestamp") if "timestamp" in messages.columns else F.current_timestamp()).cast("timestamp").alias("timestamp"),
            F.col("topic").alias("_folder")))
        write_folders(rows, path, ("_folder",), open_files=OPEN_TOPICS)
        rows = self.spark.read.schema(rows.drop("_folder").schema).parquet(path).select(
            "topic", "value", "timestamp", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_nth"))
        tasks = rows.groupBy("topic", "_file").agg(F.count("*").alias("_n"))
        before = Window.partitionBy("topic").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
        # a row a topic and file, written, so that Spark knows its size when it plans the join
        bases = stage(tasks.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))), "publication")
        start = self.end_offsets()
        first = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in start.items() for x in kv]), F.col("topic")), F.lit(0)) if start else F.lit(0)
        out = (rows.join(bases.select("topic", "_file", "_base"), ["topic", "_file"])
               .select("topic", "value", (first + F.col("_base") + F.col("_nth")).cast("long").alias("offset"), "timestamp"))
        batch = self._next(self.messages)
        self.messages.commit(out, batch)
        ends = bases.groupBy("topic").agg(F.sum("_n").alias("n")).select("topic", (first + F.col("n")).cast("long").alias("end"))
        self.ends.commit(ends, batch)
        return self.end_offsets()

    # -------------------------------------------------------------- reading

    def read(self, ranges: dict[str, tuple[int, int]]) -> DataFrame:
        """Messages of each topic from an offset up to, and without, another."""
        within = F.lit(False)
        for topic, (lo, hi) in ranges.items():
            within = within | ((F.col("topic") == topic) & F.col("offset").between(lo, hi - 1))
        return self.messages.read().select(*MESSAGE_COLUMNS).where(within)

    def position(self, group: str) -> dict[str, int]:
        """The next offset of each topic for a group; topics that it has never taken from are not in it."""
        if self.ledger.schema() is None:
            return {}
        return {r.topic: r.position for r in _latest(self.ledger.read().where(F.col("group") == group)).collect()}

    def poll(self, group: str, topics: tuple[str, ...], most: int | None = None) -> tuple[DataFrame, dict[str, int]]:
        """What a group has not taken yet of its topics, up to ``most`` messages a topic, and its position after that.

        Nothing is noted before ``take``: a consumer that fails in between gets the same messages again.
        """
        ends, at = self.end_offsets(), self.position(group)
        ranges = {t: (at.get(t, 0), min(ends[t], at.get(t, 0) + most) if most is not None else ends[t]) for t in topics if t in ends}
        return self.read(ranges), {t: hi for t, (_, hi) in ranges.items()}

    def take(self, group: str, position: dict[str, int]) -> None:
        """Note a group's position."""
        seq = self._next(self.ledger)
        rows = [(group, t, p, seq) for t, p in position.items()]
        self.ledger.commit(self.spark.createDataFrame(rows, "group string, topic string, position long, seq long"), seq)


def _latest(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("group", "topic").agg(F.max_by("position", "seq").alias("position"), F.max("seq").alias("seq"))


def offset_ledger(spark: SparkSession, messages: DataFrame, groups: dict[str, tuple[str, ...]], path: str, most: int) -> DataFrame:
    """Messages published in two halves; each group takes up to ``most`` a topic after the first, and the rest after the second.

    A row a group and topic: ``consumer, topic, taken, offsets, first_offset, last_offset, next_offset`` over both reads.
    """
    log = TopicLog(spark, path)
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    taken = None
    for i, limit in ((0, most), (1, None)):
        log.publish(messages.where(half == i))
        for group, topics in groups.items():
            new, position = log.poll(group, topics, limit)
            new = new.select(F.lit(group).alias("consumer"), "topic", "offset")
            taken = new if taken is None else taken.union(new)
            log.take(group, position)
    at = spark.createDataFrame([(g, t, p) for g in groups for t, p in log.position(g).items()], "consumer string, topic string, next_offset long")
    # distinct offsets: 64 neighbours are the bits of a word, which the tasks put together before words are shuffled
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("offset").bitwiseAND(63).cast("int"))
    words = taken.groupBy("consumer", "topic", F.shiftright("offset", 6).alias("_word")).agg(
        F.count("*").alias("_n"), F.bit_or(bit).alias("_bits"), F.min("offset").alias("_lo"), F.max("offset").alias("_hi"))
    return (words.groupBy("consumer", "topic").agg(F.sum("_n").alias("taken"), F.sum(F.bit_count("_bits")).alias("offsets"),
                                                   F.min("_lo").alias("first_offset"), F.max("_hi").alias("last_offset"))
            .join(at, ["consumer", "topic"]))
