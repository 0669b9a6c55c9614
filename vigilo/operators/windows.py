"""Sliding windows: assignment, dense spine, densification.

Windows are ``[start, start + length)`` with starts on multiples of the slide.
A window is identified by its start index ``w`` (start = ``w * slide``
seconds since the epoch), so grouping and joining use a ``long`` key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import WindowSpec
from ..functions.timefmt import index_to_ts

# Windows generated per spine row before redistribution; bounds the work of a
# single generator row no matter how long the time span is.
SPINE_CHUNK = 2048


def bucket_windows(buckets: DataFrame, spec: WindowSpec) -> DataFrame:
    """Add ``w`` to rows of whole slide buckets (``_b``): one row for each window, of ``length / slide`` slides, that holds it."""
    n = spec.length_s // spec.slide_s
    return buckets.withColumn("w", F.explode(F.sequence(F.col("_b") - (n - 1), F.col("_b"))))


def window_extent(windowed: DataFrame) -> DataFrame:
    """Per server: first bucket holding data (``lo``) and last window start (``hi``).

    ``windowed`` is a per-(server, window) aggregate that carries ``_lo`` =
    min bucket of its rows. The result has one row per server.
    """
    return windowed.groupBy("server_id").agg(F.min("_lo").alias("lo"), F.max("w").alias("hi"))


def spine(extent: DataFrame, num_partitions: int) -> DataFrame:
    """Dense ``(server_id, w)`` grid: every server × every start from the global first to the global last.

    The global bounds are scalar subqueries over the per-server extent (one
    value each; nothing passes through the driver as data). Generation is in
    two steps so no single row or task produces an unbounded run: chunks of
    ``SPINE_CHUNK`` starts are spread over ``num_partitions`` tasks, then
    each chunk expands locally.
    """
    lo = extent.agg(F.min("lo")).scalar()
    hi = extent.agg(F.max("hi")).scalar()
    c = F.lit(SPINE_CHUNK)
    chunks = extent.select(
        "server_id",
        F.explode(F.sequence(F.floor(lo / c), F.floor(hi / c))).alias("_chunk"),
    )
    first = F.greatest(lo, F.col("_chunk") * c)
    last = F.least(hi, F.col("_chunk") * c + c - 1)
    return (chunks.repartition(num_partitions, "server_id", "_chunk")
            .select("server_id", F.explode(F.sequence(first, last)).alias("w")))


def densify(windowed: DataFrame, num_partitions: int) -> DataFrame:
    """Left-join the dense spine to a per-(server, window) aggregate.

    Empty windows get NULL metrics; windows starting before the first aligned
    start (warm-up) fall outside the spine and disappear. Servers are those in
    ``windowed``.
    """
    return spine(window_extent(windowed), num_partitions).join(windowed, ["server_id", "w"], "left")


def window_bounds_cols(w: Column | str, spec: WindowSpec) -> tuple[Column, Column]:
    """Start and end timestamps of window index ``w``."""
    w = F.col(w) if isinstance(w, str) else w
    start = index_to_ts(w, spec.slide_s)
    end = F.timestamp_seconds(w * F.lit(spec.slide_s) + F.lit(spec.length_s))
    return start, end
