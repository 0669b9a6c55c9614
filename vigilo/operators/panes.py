"""Sliding aggregation in work proportional to buckets and windows, however many windows hold a bucket.

Time is cut into panes, the largest stretches that windows begin and end on, and a server's panes into
blocks of as many panes as a window has. A window then spans at most two blocks: the end of one and the
beginning of the next. So two running aggregates over each block, one from its front and one from its
back, give every window from two rows, whatever aggregate it is (sums are only ever added up, never
subtracted, so no digits are lost and NaN or infinity stay in their windows). Rows are never repeated for
the windows that hold them.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import WindowSpec
from ..session import stage
from .windows import SPINE_CHUNK

GRID_ROWS = 500_000       # panes of the grid that a task holds, about


def pane_seconds(spec: WindowSpec) -> int:
    return gcd(spec.length_s, spec.slide_s)


def _islands(panes: DataFrame, n: int) -> DataFrame:
    """(server_id, lo, hi): first and last pane of stretches so far apart that no pane is of windows of two of them."""
    order = Window.partitionBy("server_id").orderBy("_p")
    marked = panes.select("server_id", "_p", (F.col("_p") - F.lag("_p").over(order) >= 2 * n - 1).alias("_far"))
    number = F.count_if("_far").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn("_island", number).groupBy("server_id", "_island").agg(F.min("_p").alias("lo"), F.max("_p").alias("hi"))


def _ends(islands: DataFrame, n: int, first: Column | None) -> DataFrame:
    """(server_id, from, to): stretches of the panes that an island's windows begin or end with; windows from pane ``first`` on, if given."""
    hi, lo = F.col("hi"), F.col("lo") - (n - 1)
    lo = lo if first is None else F.greatest(lo, first)
    pair = lambda a, b: F.struct(a.alias("from"), b.alias("to"))
    apart = F.array(pair(lo, hi), pair(lo + (n - 1), hi + (n - 1)))
    return islands.select("server_id", F.inline(F.when(hi + 1 < lo + (n - 1), apart).otherwise(F.array(pair(lo, hi + (n - 1))))))


def _grid(ends: DataFrame, tasks: int) -> DataFrame:
    """Every pane of the stretches, in chunks that are spread over tasks before they are expanded."""
    c = F.lit(SPINE_CHUNK)
    chunks = ends.withColumn("_chunk", F.explode(F.sequence(F.floor(F.col("from") / c), F.floor(F.col("to") / c))))
    first, last = F.greatest("from", F.col("_chunk") * c), F.least("to", F.col("_chunk") * c + c - 1)
    return chunks.repartition(tasks, "server_id", "_chunk").select("server_id", F.explode(F.sequence(first, last)).alias("_p"))


def sliding(panes: DataFrame, spec: WindowSpec, merge: dict[str, Column], tasks: int, aligned: bool = False) -> DataFrame:
    """``server_id, w`` and the merged columns of every window that holds a pane, and ``_p_lo``, its first pane with data.

    panes: one row for each (server_id, ``_p``), ``_p`` a pane's number from the epoch; merge: for each column
    the aggregate that merges it (``F.sum`` or ``F.max`` of the column, any that ignores nulls). Windows begin on slides.
    ``aligned``: only windows from the slide on that holds the first pane of all.

    The panes are staged, being read for the bounds, the islands and the aggregates. Running aggregates are dealt over ``tasks``
    tasks or more, so many that each has GRID_ROWS rows or so, whatever the input.
    """
    p = pane_seconds(spec)
    n, per_slide = spec.length_s // p, spec.slide_s // p
    merge = {**merge, "_p_lo": F.min("_p_lo")}
    panes = stage(panes.withColumn("_p_lo", F.col("_p")), "panes")
    first = panes.select((F.floor(F.min("_p") / per_slide) * per_slide).cast("long").alias("p")).scalar() if aligned else None
    ends = stage(_ends(_islands(panes, n), n, first), "pane-ends")
    rows = ends.agg(F.sum(F.col("to") - F.col("from") + 1).alias("n")).first().n or 0
    tasks = max(tasks, -(-rows // GRID_ROWS))
    # panes of the grid next to those with data: peers in a range frame, so a pane of the grid has its data without a join
    grid = _grid(ends, tasks).withColumn("_grid", F.lit(True)).unionByName(panes, allowMissingColumns=True)
    grid = grid.withColumn("_block", F.floor(F.col("_p") / n)).repartition(tasks, "server_id", "_block")
    front = Window.partitionBy("server_id", "_block").orderBy("_p").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy("server_id", "_block").orderBy(F.desc("_p")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = grid.select("server_id", "_p", "_grid", *[agg.over(front).alias(f"_f{c}") for c, agg in merge.items()],
                          *[agg.over(back).alias(f"_b{c}") for c, agg in merge.items()]).where("_grid")
    # from pane p on: the rest of its block; up to pane p: its block so far, unless that is the whole block, which is the first kind's
    begins = F.struct(F.col("_p").alias("_s"), *[F.col(f"_b{c}").alias(c) for c in merge])
    ends = F.struct(F.when(F.pmod("_p", F.lit(n)) != n - 1, F.col("_p") - (n - 1)).alias("_s"), *[F.col(f"_f{c}").alias(c) for c in merge])
    halves = running.select("server_id", F.inline(F.array(begins, ends)))
    kept = F.col("_p_lo").isNotNull() & F.col("_s").isNotNull() & (F.pmod("_s", F.lit(per_slide)) == 0)
    windows = (halves.where(kept if first is None else kept & (F.col("_s") >= first))
               .groupBy("server_id", "_s").agg(*[agg.alias(c) for c, agg in merge.items()]))
    return windows.select("server_id", F.floor(F.col("_s") / per_slide).cast("long").alias("w"), *merge)
