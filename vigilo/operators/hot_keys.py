"""The literal pair join with hot keys split over tasks.

A key with m rows on one side and n on the other makes m * n pairs, and a hash join makes all of them in one
task. Here the rows of each key are counted first (one map-side aggregation over both feeds). Of a key with more than
``block`` squared pairs, the rows of either side are dealt into groups, and each group meets each group
of the other side in a cell of its own: a cell holds about ``block`` squared pairs however hot the key is. A row is
repeated once for each group of the other side; all other keys are joined as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .pairing import KEYS, pair_join

BLOCK = 1024             # a cell's side: about a million pairs


def key_load(a: DataFrame, b: DataFrame, block: int = BLOCK) -> DataFrame:
    """``ts, server_id, a_n, b_n, pairs, a_parts, b_parts`` of every key on both sides.

    ``a_parts`` and ``b_parts`` are the groups that each side's rows are dealt into; both are 1 up to ``block`` squared
    pairs. A side of fewer than ``block`` rows stays whole and the other side's groups are larger. Keys with a NULL don't pair.
    """
    if block < 1:
        raise ValueError(f"block must be at least 1, got {block!r}")
    sides = a.select(*KEYS, F.lit(0).alias("_side")).unionByName(b.select(*KEYS, F.lit(1).alias("_side")))
    counted = (sides.where(" and ".join(f"{k} is not null" for k in KEYS)).groupBy(*KEYS)
               .agg(F.count_if(F.col("_side") == 0).alias("a_n"), F.count_if(F.col("_side") == 1).alias("b_n"))
               .where("a_n > 0 and b_n > 0"))
    # doubles: the product of two counts may be beyond a long
    area = float(block) * block

    def parts(mine: str, other: str):
        cut = F.ceil(F.col(mine) * F.least(F.col(other), F.lit(block)).cast("double") / F.lit(area))
        return F.when(F.col("a_n").cast("double") * F.col("b_n") > area, cut).otherwise(F.lit(1)).cast("long")

    return counted.select(*KEYS, "a_n", "b_n", (F.col("a_n").cast("double") * F.col("b_n")).alias("pairs"),
                          parts("a_n", "b_n").alias("a_parts"), parts("b_n", "a_n").alias("b_parts"))


def _dealt(rows: DataFrame, hot: DataFrame, mine: str, other: str, name: str) -> DataFrame:
    """Rows of hot keys, each dealt at random into one group of its side, as a table.

    The draw is written before it is used: a task that runs again after a loss must not draw anew.
    """
    drawn = rows.join(hot.select(*KEYS, F.col(f"{mine}_parts").alias("_mine"), F.col(f"{other}_parts").alias("_theirs")), list(KEYS))
    return stage(drawn.withColumn(f"_{mine}", F.floor(F.rand() * F.col("_mine")).cast("long")).drop("_mine"), name)


def _in_cells(dealt: DataFrame, other: str) -> DataFrame:
    """Each row once for every group of the other side."""
    return dealt.withColumn(f"_{other}", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_theirs") - 1))).drop("_theirs")


def hot_pairs(a: DataFrame, b: DataFrame, hot: DataFrame) -> DataFrame:
    """All pairs of the keys in ``hot`` (a staged part of ``key_load``), joined by cells."""
    left = _in_cells(_dealt(a, hot, "a", "b", "hot-first"), "b")
    right = _in_cells(_dealt(b, hot, "b", "a", "hot-second"), "a")
    # hashed by cell: a broadcast side would leave a hot key's pairs where its rows lie
    return left.hint("merge").join(right.hint("merge"), [*KEYS, "_a", "_b"]).drop("_a", "_b")


def split_pair_join(a: DataFrame, b: DataFrame, block: int = BLOCK) -> DataFrame:
    """``pair_join`` without a task that makes all pairs of a hot key: same rows, same columns.

    NULL keys drop out, repeated rows multiply, an empty side gives no rows; columns named ``_a, _b, _mine, _theirs``
    are refused. Without hot keys this is the plain join.
    """
    taken = {"_a", "_b", "_mine", "_theirs"} & {*a.columns, *b.columns}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are used by the join")
    hot = stage(key_load(a, b, block).where("a_parts * b_parts > 1"), "hot-keys")
    if not hot.limit(1).count():
        return pair_join(a, b)
    keys = hot.select(*KEYS)
    cold = pair_join(a.join(keys, list(KEYS), "left_anti"), b.join(keys, list(KEYS), "left_anti"))
    return cold.unionByName(hot_pairs(a, b, hot).select(cold.columns))
