"""Intermediate views of the windowed jobs: pairs, bounds, starts, servers, spine, summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PairJobSpec
from ..functions.timefmt import floor_to_slide, slide_index
from ..operators.hot_keys import BLOCK, split_pair_join
from ..operators.pairing import pair_stats
from ..operators.windows import spine, window_bounds_cols
from .alert_jobs import finish, joined_pairs, load_rounded, windowed_stats

FULL_TS = "yyyy-MM-dd HH:mm:ss"


def _keys(a: DataFrame, b: DataFrame, job: PairJobSpec) -> DataFrame:
    """Distinct ``(ts, server_id)`` keys present in both inputs (the pair join's keys)."""
    fa, fb = job.first.column, job.second.column
    return pair_stats(load_rounded(a, fa), fa, load_rounded(b, fb), fb, "max").select("ts", "server_id")


def pairs_table(a: DataFrame, b: DataFrame, job: PairJobSpec) -> DataFrame:
    """The literal inner pair join with the timestamp as text."""
    j = joined_pairs(a, b, job)
    return j.select(F.date_format("ts", FULL_TS).alias("ts"), "server_id", job.first.column, job.second.column)


def split_pairs_table(a: DataFrame, b: DataFrame, job: PairJobSpec, block: int = BLOCK) -> DataFrame:
    """``pairs_table`` with keys of more than ``block`` squared pairs split over tasks."""
    fa, fb = job.first.column, job.second.column
    j = split_pair_join(load_rounded(a, fa), load_rounded(b, fb), block)
    return j.select(F.date_format("ts", FULL_TS).alias("ts"), "server_id", fa, fb)


def spine_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bounds(a: DataFrame, b: DataFrame, job: PairJobSpec) -> DataFrame:
    """One row: first/last paired sample, first/last aligned window start, number of starts."""
    s = job.window.slide_s
    k = _keys(a, b, job).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    first, last = slide_index("lo", s), slide_index("hi", s)
    return k.select(
        F.date_format("lo", FULL_TS).alias("min_ts"),
        F.date_format("hi", FULL_TS).alias("max_ts"),
        F.date_format(floor_to_slide("lo", s), FULL_TS).alias("first_start"),
        F.date_format(floor_to_slide("hi", s), FULL_TS).alias("last_start"),
        (last - first + 1).alias("n_starts"),
    )


def starts(a: DataFrame, b: DataFrame, job: PairJobSpec) -> DataFrame:
    """Every window start from the first aligned start through the last sample."""
    s = job.window.slide_s
    k = _keys(a, b, job).agg(slide_index(F.min("ts"), s).alias("lo"), slide_index(F.max("ts"), s).alias("hi"))
    w = spine(k.where("lo is not null").select(F.lit("").alias("server_id"), "lo", "hi"), spine_tasks(a))
    st, en = window_bounds_cols("w", job.window)
    return w.select(F.date_format(st, FULL_TS).alias("window_start"), F.date_format(en, FULL_TS).alias("window_end"))


def servers(a: DataFrame, b: DataFrame, job: PairJobSpec) -> DataFrame:
    """Servers present in the pair join."""
    return _keys(a, b, job).select("server_id").distinct()


def dense_spine(a: DataFrame, b: DataFrame, job: PairJobSpec) -> DataFrame:
    """Every server × every window start (no data columns)."""
    s = job.window.slide_s
    extent = _keys(a, b, job).groupBy("server_id").agg(
        slide_index(F.min("ts"), s).alias("lo"), slide_index(F.max("ts"), s).alias("hi"))
    sp = spine(extent, spine_tasks(a))
    st, en = window_bounds_cols("w", job.window)
    return sp.select("server_id", F.date_format(st, FULL_TS).alias("window_start"),
                     F.date_format(en, FULL_TS).alias("window_end"))


def nonempty_windows(a: DataFrame, b: DataFrame, job: PairJobSpec) -> DataFrame:
    """Windows that hold at least one pair, as Spark's sliding ``window()`` yields them
    (including windows that begin before the first aligned start)."""
    return finish(windowed_stats(a, b, job), job, dense=False, sort=False)


def alert_summary(results: dict[str, DataFrame]) -> DataFrame:
    """Windows per (job, alert) over the dense results of several jobs."""
    parts = [df.select(F.lit(name).alias("job"), "alert") for name, df in results.items()]
    u = reduce(DataFrame.unionByName, parts)
    return u.groupBy("job", "alert").agg(F.count(F.lit(1)).alias("windows"))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per loaded input: one aggregate per input, combined."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("input"), "rows")
             for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)
