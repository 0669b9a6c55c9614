"""Server telemetry derived from the driver's ``lineitem`` table.

The monitored pipeline ships no data, so the test and bench inputs are a fixed
projection of all of ``lineitem``: 600 one-second ticks from 2024-01-01 00:00:05
UTC, a server for each supplier (so servers, keys and windows grow with the
table), some servers biased over the thresholds. Servers of every fifth supplier
key are silent for 60 s, so that some windows are empty: their samples of that
minute carry the times of the minute before. The projection is plain
column arithmetic, so Catalyst prunes ``lineitem`` to the five columns used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture projection (shared with the DuckDB oracle text).
FIXTURE_EPOCH = 1704067205     # 2024-01-01 00:00:05 UTC
FIXTURE_TICKS = 600

#: Session setting: deal the rows of each source table to so many tasks. Unset: the scan's own splits.
SOURCE_TASKS = "spark.vigilo.sourceTasks"


def spread(df: DataFrame, tasks: int | None) -> DataFrame:
    """Round-robin over ``tasks`` tasks when the caller asks for it, else the frame itself."""
    return df.repartition(tasks) if tasks else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tasks = spark.conf.get(SOURCE_TASKS, None)
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"), int(tasks) if tasks else None)


def _time() -> Column:
    tick, sk = F.col("l_orderkey") % FIXTURE_TICKS, F.col("l_suppkey")
    return F.timestamp_seconds(F.lit(FIXTURE_EPOCH) + tick - F.when((sk % 5 == 0) & tick.between(300, 359), 60).otherwise(0))


def _server() -> Column:
    return F.concat(F.lit("srv-"), F.col("l_suppkey").cast("string"))


def _fixture_columns() -> dict[str, Column]:
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    q, price, tax = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_tax")
    return {
        "ts": _time(),
        "server_id": _server(),
        "cpu_pct": F.when(sk % 2 == 0, F.lit(80) + q * 0.4).otherwise(q).cast("float"),
        "mem_pct": F.when(sk % 3 == 0, F.lit(80) + (pk % 50) * F.expr("0.4"))
                    .otherwise(pk % 80).cast("float"),
        "net_in": (price / 14).cast("float"),
        "net_out": (price / 20).cast("float"),
        "disk_io": ((pk * 13 % 4300) + tax).cast("float"),
    }


def telemetry(lineitem: DataFrame) -> DataFrame:
    """Typed wide telemetry: ``ts, server_id, cpu_pct, mem_pct, net_in, net_out, disk_io``."""
    cols = _fixture_columns()
    return lineitem.select(*[c.alias(n) for n, c in cols.items()])


def metric_frames(lineitem: DataFrame) -> dict[str, DataFrame]:
    """The four narrow typed tables the batch jobs consume."""
    wide = telemetry(lineitem)
    return {
        "cpu": wide.select("ts", "server_id", "cpu_pct"),
        "mem": wide.select("ts", "server_id", "mem_pct"),
        "net": wide.select("ts", "server_id", "net_in", "net_out"),
        "disk": wide.select("ts", "server_id", "disk_io"),
    }


def load_metrics(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return metric_frames(read_table(spark, sf_dir, "lineitem"))


def _cents_text(cents: Column) -> Column:
    """Non-negative integer cents as ``d.dd`` text."""
    return F.concat((cents / 100).cast("long").cast("string"), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"))


def wide_text(lineitem: DataFrame) -> DataFrame:
    """The producer's wide CSV rows, all text, derived from ``lineitem``.

    Values are written with two decimals from integer cents so that every
    engine prints them identically; ``ts`` is ``yyyy-MM-dd HH:mm:ss``.
    """
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    q, price, tax = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_tax")
    cents = {
        "cpu_pct": F.when(sk % 2 == 0, F.lit(8000) + q * 40).otherwise(q * 100),
        "mem_pct": F.when(sk % 3 == 0, F.lit(8000) + (pk % 50) * 40).otherwise((pk % 80) * 100),
        "net_in": F.round(price * 100 / 14),
        "net_out": F.round(price * 100 / 20),
        "disk_io": (pk * 13 % 4300) * 100 + F.round(tax * 100),
    }
    return lineitem.select(
        F.date_format(_time(), "yyyy-MM-dd HH:mm:ss").alias("ts"),
        _server().alias("server_id"),
        *[_cents_text(F.round(c).cast("long")).alias(n) for n, c in cents.items()],
    )
