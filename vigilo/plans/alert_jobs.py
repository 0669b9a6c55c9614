"""The two windowed alert jobs (CPU+MEM averages, NET+DISK maxima).

Plan shape (the windowed aggregate is staged in the shared folder for dense results, the rest is lazy):

  scan a ─┐
          ├─ union ─ partial agg ─ [shuffle ts,server] ─ final agg   (pair_stats: per-key n, c, sum / max)
  scan b ─┘
     ─ partial agg ─ [shuffle server,bucket] ─ final agg   (per slide bucket)
     ─ explode buckets into their L/S windows ─ partial agg ─ [shuffle server,w] ─ final agg   (windowed;
       many windows a bucket, or windows that aren't whole slides: running aggregates over panes instead)
     ─ LEFT JOIN dense spine on (server,w)
     ─ round, CASE ─ [range shuffle] ─ sort (server_id, window start)

Averages over the m*n pair join are reproduced exactly by weighting each
side's per-key sum and count by the other side's row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CPU_MEM_JOB, NET_DISK_JOB, PairJobSpec
from ..functions.metrics import pair_alert, round2_float
from ..functions.timefmt import hms, slide_index
from ..operators.pairing import pair_join, pair_stats
from ..operators.panes import pane_seconds, sliding
from ..operators.windows import bucket_windows, densify, window_bounds_cols
from ..session import stage

EXPAND = 8       # windows that a bucket is repeated for at most; beyond that the aggregate slides over panes


def _num_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def load_rounded(df: DataFrame, value_col: str) -> DataFrame:
    """``ts, server_id, <value>`` with the value cast to float and rounded to 2 decimals."""
    return df.select("ts", "server_id", round2_float(value_col).alias(value_col))


def _weighted(stats: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Sums over the m*n pairs of each key: a side's sum and count times the other side's rows (doubles: no overflow)."""
    return stats.select("ts", "server_id", *keep, *[
        (F.col(x) * F.col(n).cast("double")).alias(name)
        for name, x, n in (("_as", "a_s", "b_n"), ("_ac", "a_c", "b_n"), ("_bs", "b_s", "a_n"), ("_bc", "b_c", "a_n"))])


def windowed_stats(a: DataFrame, b: DataFrame, job: PairJobSpec, aligned: bool = False) -> DataFrame:
    """Per (server_id, w) aggregate over non-empty windows (warm-up windows included, unless ``aligned`` leaves out those it can tell early).

    Columns: ``server_id, w, _lo`` and ``x_a, x_b`` = the unrounded avg or max.
    """
    fa, fb = job.first.column, job.second.column
    return windows_of_keys(pair_stats(load_rounded(a, fa), fa, load_rounded(b, fb), fb, job.how), job, aligned=aligned)


def windows_of_keys(stats: DataFrame, job: PairJobSpec, flags: tuple[str, ...] = (), expand: int = EXPAND, aligned: bool = False) -> DataFrame:
    """``windowed_stats`` from the statistics of paired keys.

    Keys are summed up per slide bucket first. Where up to ``expand`` windows hold a bucket, buckets are repeated
    for their windows; where there are more, or windows aren't whole slides, the aggregate slides over panes
    (``operators.panes``; with ``aligned`` without the warm-up windows). ``flags``: columns of which a window gets the largest value.
    """
    spec = job.window.validate()
    if job.how == "avg":
        keys, merge = _weighted(stats, flags), {c: F.sum(c) for c in ("_as", "_ac", "_bs", "_bc")}
    else:
        keys, merge = stats, {c: F.max(c) for c in ("a_m", "b_m")}
    merge |= {c: F.max(c) for c in flags}
    whole = spec.length_s % spec.slide_s == 0
    step = spec.slide_s if whole else pane_seconds(spec)
    buckets = (keys.withColumn("_b", slide_index("ts", step)).groupBy("server_id", "_b").agg(*[agg.alias(c) for c, agg in merge.items()]))
    if whole and spec.length_s // spec.slide_s <= expand:
        g = bucket_windows(buckets, spec).groupBy("server_id", "w").agg(*[agg.alias(c) for c, agg in merge.items()], F.min("_b").alias("_lo"))
    else:
        g = sliding(buckets.withColumnRenamed("_b", "_p"), spec, merge, _num_partitions(stats), aligned)
        g = g.withColumn("_lo", F.floor(F.col("_p_lo") * step / spec.slide_s).cast("long"))
    if job.how == "avg":
        return g.select("server_id", "w", "_lo", F.try_divide("_as", "_ac").alias("x_a"), F.try_divide("_bs", "_bc").alias("x_b"), *flags)
    return g.select("server_id", "w", "_lo", F.col("a_m").alias("x_a"), F.col("b_m").alias("x_b"), *flags)


def finish(windowed: DataFrame, job: PairJobSpec, dense: bool = True, sort: bool = True,
           keep_start_ts: bool = False) -> DataFrame:
    """Round, classify and format a windowed aggregate into the result table."""
    spec = job.window
    if dense:
        # The aggregate feeds the spine bounds, the server list and the join:
        # materialise it once instead of letting each consumer rescan the input.
        windowed = stage(windowed, f"windowed-{job.label.lower()}")
        df = densify(windowed, _num_partitions(windowed))
    else:
        df = windowed.drop("_lo")
    start, end = window_bounds_cols("w", spec)
    a, b = F.round("x_a", 2), F.round("x_b", 2)
    out = df.select(
        "server_id", "w",
        hms(start).alias("window_start"),
        hms(end).alias("window_end"),
        a.alias(job.out_first),
        b.alias(job.out_second),
    ).withColumn("alert", pair_alert(job.out_first, job.out_second, job))
    if sort:
        out = out.orderBy("server_id", "w")
    if keep_start_ts:
        out = out.withColumn("window_start_ts", start)
    return out.drop("w")


def pair_alerts(a: DataFrame, b: DataFrame, job: PairJobSpec, dense: bool = True,
                sort: bool = True) -> DataFrame:
    """Windowed alert table for one job: ``server_id, window_start, window_end, <m1>, <m2>, alert``."""
    job.window.validate()
    return finish(windowed_stats(a, b, job, aligned=dense), job, dense=dense, sort=sort)


def cpu_mem_alerts(cpu: DataFrame, mem: DataFrame, job: PairJobSpec = CPU_MEM_JOB, **kw) -> DataFrame:
    """Per server and 30 s window (every 10 s): rounded CPU and memory averages and the alert."""
    return pair_alerts(cpu, mem, job, **kw)


def net_disk_alerts(net: DataFrame, disk: DataFrame, job: PairJobSpec = NET_DISK_JOB, **kw) -> DataFrame:
    """Per server and 30 s window (every 10 s): rounded network-in and disk-io maxima and the alert."""
    return pair_alerts(net, disk, job, **kw)


def joined_pairs(a: DataFrame, b: DataFrame, job: PairJobSpec) -> DataFrame:
    """The literal pair join of the rounded inputs (kept for reports and equivalence tests)."""
    fa, fb = job.first.column, job.second.column
    return pair_join(load_rounded(a, fa), load_rounded(b, fb))
