"""Sharding over fixed virtual slots.

A record belongs for good to one of a few thousand virtual slots, by a hash of its id. Bytes are
summed per slot, and a slot-to-shard map says which shard serves a slot. The map is a versioned
table: version 1 deals the slots out in turn, and rebalancing edits it into the next version by
moving whole slots from heavy shards to light ones. Only the slots' sums (as many rows as there are
slots, a parameter) reach the driver; records are placed by joins and aggregations.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import scratch_path

VIRTUAL_SLOTS = 4096
CHUNKS = 64                 # numbering groups of a virtual slot; none holds more than its share
_MAP = "version int, vslot int, shard int"


def initial_map(slots: int, shards: int) -> dict[int, int]:
    return {s: s % shards for s in range(slots)}


def rebalanced(slot_map: dict[int, int], weight: dict[int, int], shards: int) -> dict[int, int]:
    """The map edited until the shards' weights are near equal.

    Slots of shards above the mean are released, lightest last, and handed out again, heaviest first,
    to the lightest shard; then single slots move, or trade places, between the heaviest and the
    lightest shard while that narrows the gap. Shards 0 to shards - 1 may be new ones.
    """
    out = dict(slot_map)
    load = [0] * shards
    of = [set() for _ in range(shards)]
    free = [s for s, k in out.items() if k >= shards]
    for s, k in out.items():
        if k < shards:
            of[k].add(s)
            load[k] += weight.get(s, 0)
    mean = sum(weight.get(s, 0) for s in out) / shards
    for k in range(shards):
        for s in sorted(of[k], key=lambda s: (-weight.get(s, 0), s)):
            if load[k] > mean and weight.get(s, 0):
                of[k].discard(s)
                load[k] -= weight[s]
                free.append(s)
    heap = [(load[k], k) for k in range(shards)]
    heapq.heapify(heap)
    for s in sorted(free, key=lambda s: (-weight.get(s, 0), s)):
        _, k = heapq.heappop(heap)
        of[k].add(s)
        load[k] += weight.get(s, 0)
        heapq.heappush(heap, (load[k], k))
    for _ in range(4 * len(out)):
        hi, lo = max(range(shards), key=lambda k: (load[k], -k)), min(range(shards), key=lambda k: (load[k], k))
        gap = load[hi] - load[lo]
        best, change = None, 0
        light = sorted(((weight.get(s, 0), s) for s in of[lo]), reverse=True) + [(0, None)]
        j = 0
        for w, s in sorted(((weight.get(s, 0), s) for s in of[hi]), reverse=True):
            while j < len(light) - 1 and w - light[j][0] < gap / 2:
                j += 1
            for x in light[max(0, j - 1): j + 1]:
                d = w - x[0]
                if 0 < d < gap and min(d, gap - d) > change:
                    best, change = (s, x[1], d), min(d, gap - d)
        if best is None:
            break
        s, x, d = best
        of[hi].discard(s)
        of[lo].add(s)
        if x is not None:
            of[lo].discard(x)
            of[hi].add(x)
        load[hi] -= d
        load[lo] += d
    for k in range(shards):
        for s in of[k]:
            out[s] = k
    return out


def save_map(spark: SparkSession, path: str, version: int, slot_map: dict[int, int]) -> None:
    """Write one version beside the others; a version is never changed once written."""
    rows = [(version, s, k) for s, k in sorted(slot_map.items())]
    spark.createDataFrame(rows, _MAP).coalesce(1).write.parquet(f"{path}/v{version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(_MAP).parquet(f"{path}/v{version}")


def with_slots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 8), text_crc32 and the record's virtual slot."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(F.lit("slot"), F.col(id_col).cast("long")), F.lit(slots)).cast("int").alias("vslot"))


def shard(docs: DataFrame, shards: int, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
          slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """Place every row: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null), map_version.

    slot is the place in the shard, gapless from 0: rows are numbered within a virtual slot and chunk,
    and the numbers of what stands before are added, so no shard is one task's group. path takes the
    versions of the map (a scratch folder of the shared one by default). A null text has no bytes, a
    null id is an id like any other, repeated rows are placed each; an empty table gives no rows. Rows
    of one id share a slot: shards are near equal as long as no id holds more than a shard's share.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "slot-map")
    placed = with_slots(docs, id_col, text_col, slots)
    weight = {r.vslot: r.w for r in placed.groupBy("vslot").agg(F.sum("size").alias("w")).collect()}
    first = initial_map(slots, shards)
    save_map(spark, path, 1, first)
    save_map(spark, path, 2, rebalanced(first, weight, shards))
    slot_map = load_map(spark, path, 2)

    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(CHUNKS)).cast("int"))
    counts = placed.groupBy("vslot", "chunk").agg(F.count("*").alias("n")).join(slot_map, "vslot")
    before = Window.partitionBy("shard").orderBy("vslot", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("vslot", "chunk", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    number = F.row_number().over(Window.partitionBy("vslot", "chunk").orderBy("doc_id", "text_crc32", "size"))
    return (placed.withColumn("number", number).join(counts, ["vslot", "chunk"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("base") + F.col("number") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                    "vslot", F.lit(2).alias("map_version")))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 24 shards."""
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), 24)
