"""Pairing two metric feeds on ``(ts, server_id)``.

``pair_join`` is the literal inner equi-join: m rows on one side and n on the
other give m*n rows, and that multiplicity weights later averages.

``pair_stats`` computes the same information without materialising the m*n
product: one aggregation over the *union* of both feeds yields, per key and
per side, the row count ``n``, the non-null count ``c``, the double sum ``s``
and the max ``m``. Partial aggregation runs map-side before the only shuffle,
so a hot key (even a third of all rows) costs one row per map task, and no
join (hence no join skew) is involved. Keys seen on one side only are dropped,
exactly like the inner join drops them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("ts", "server_id")


def pair_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner equi-join on ``(ts, server_id)``; NULL keys drop out, duplicates multiply."""
    return a.join(b, list(KEYS), "inner")


def _side(df: DataFrame, value_col: str, side: int) -> DataFrame:
    return df.select(
        F.col("ts"), F.col("server_id"),
        F.lit(side).cast("byte").alias("_side"),
        F.col(value_col).cast("float").alias("_v"),
    ).where(F.col("ts").isNotNull() & F.col("server_id").isNotNull())


def both_sides(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> DataFrame:
    """The rows of both feeds that have a key, as one frame (or stream): ``ts, server_id, _side, _v``."""
    return _side(a, a_col, 0).unionByName(_side(b, b_col, 1))


def key_partials(a: DataFrame, a_col: str, b: DataFrame, b_col: str, how: str = "avg") -> DataFrame:
    """Per-key statistics of both sides, one row per ``(ts, server_id)`` on either side; see ``merge_partials``.

    Columns: ``ts, server_id, a_n, b_n`` plus ``a_s, a_c, b_s, b_c`` for
    ``how="avg"`` or ``a_m, b_m`` for ``how="max"``.
    """
    return side_partials(both_sides(a, a_col, b, b_col), how)


def side_partials(u: DataFrame, how: str = "avg") -> DataFrame:
    """``key_partials`` of rows that are ``both_sides`` already."""
    if how not in ("avg", "max"):
        raise ValueError(f"how must be 'avg' or 'max', got {how!r}")
    side, v = F.col("_side"), F.col("_v")
    aggs = [F.count_if(side == 0).alias("a_n"), F.count_if(side == 1).alias("b_n")]
    for tag, s in (("a", 0), ("b", 1)):
        mine = F.when(side == s, v)
        if how == "avg":
            aggs += [F.sum(mine.cast("double")).alias(f"{tag}_s"), F.count(mine).alias(f"{tag}_c")]
        else:
            aggs += [F.max(mine).alias(f"{tag}_m")]
    return u.groupBy(*KEYS).agg(*aggs)


def merge_partials(partials: DataFrame, how: str, *more: Column, dealt_by: tuple[str, ...] = ()) -> DataFrame:
    """Partials of several batches of rows as those of all the rows: counts and sums add up, maxima are maxima.

    ``dealt_by``: columns that follow from the keys; rows that are dealt by the server and these stay where they are.
    """
    columns = ("a_n", "b_n", "a_s", "a_c", "b_s", "b_c") if how == "avg" else ("a_n", "b_n", "a_m", "b_m")
    return partials.groupBy(*KEYS, *dealt_by).agg(*[(F.max if c.endswith("_m") else F.sum)(c).alias(c) for c in columns], *more)


def on_both_sides(partials: DataFrame) -> DataFrame:
    """The keys that the inner join keeps."""
    return partials.where((F.col("a_n") > 0) & (F.col("b_n") > 0))


def pair_stats(a: DataFrame, a_col: str, b: DataFrame, b_col: str, how: str = "avg") -> DataFrame:
    """``key_partials`` of the keys on both sides."""
    return on_both_sides(key_partials(a, a_col, b, b_col, how))
