"""The whole batch flow through files, as the monitored pipeline runs it.

wide CSV (scan S2) → four topic messages → consumer decode → per-topic metric
CSVs (append K2) → metric CSV scans (S1) → windowed alert job → result CSV (K3).
Each hand-off is a real file in the shared folder, so these plans check the
file formats end to end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_TEAM_NO, PairJobSpec, output_name
from ..operators.messages import accepted, decode_messages, split_wide, typed_table
from ..session import scratch_path
from ..schemas import result_schema
from ..sources.files import (
    append_metric_csv, read_metric_csv, read_result_csv, read_wide_csv, write_csv, write_result,
)
from ..sources.telemetry import wide_text
from .alert_jobs import pair_alerts


def stage_wide_csv(spark: SparkSession, lineitem: DataFrame, work: str) -> str:
    """Write the producer's wide input file (a CSV directory) and return its path."""
    path = f"{work}/dataset_csv"
    write_csv(wide_text(lineitem), path)
    return path


def ingest_to_csv(spark: SparkSession, wide_csv: str, job: PairJobSpec, work: str, fmt: str = "json",
                  base_date: str | None = None) -> dict[str, str]:
    """Producer split + consumer decode, appending each topic's typed rows to its CSV.

    Topic by topic: each message is encoded and decoded once, straight into its topic's file; only the wide file is read for each.
    """
    wide = read_wide_csv(spark, wide_csv)
    paths = {}
    for m in (job.first, job.second):
        parsed = accepted(decode_messages(split_wide(wide, fmt, (m,)), fmt, (m,), base_date))
        paths[m.column] = f"{work}/{m.topic}_csv"
        append_metric_csv(typed_table(parsed, m), paths[m.column])
    return paths


def run_alert_job(spark: SparkSession, first_csv: str, second_csv: str, job: PairJobSpec, out_dir: str,
                  team_no: str = DEFAULT_TEAM_NO, base_date: str | None = None, counts: dict | None = None) -> str:
    """The batch job as the monitored pipeline runs it: two metric CSVs in, one result CSV out.

    Returns the result path (``<out_dir>/team_<n>_<LABEL>.csv``, a directory of
    ordered part files). When ``counts`` is given it receives the rows loaded
    per input, and ``<input>_without_ts`` where rows had no full timestamp and so are in no window. An input whose rows all lack one
    (bare times and no ``base_date``) is an error.
    """
    return run_alerts(read_metric_csv(spark, first_csv, job.first, base_date),
                      read_metric_csv(spark, second_csv, job.second, base_date), job, out_dir, team_no, counts)


def run_alerts(a: DataFrame, b: DataFrame, job: PairJobSpec, out_dir: str, team_no: str = DEFAULT_TEAM_NO,
               counts: dict | None = None) -> str:
    """``run_alert_job`` for typed metric tables of any source."""
    for df, m in ((a, job.first), (b, job.second)):
        if counts is None and df.where(F.col("ts").isNotNull()).head(1):
            continue                         # one row with a timestamp is enough, and no count was asked for
        r = df.agg(F.count("*").alias("rows"), F.count_if(F.col("ts").isNull()).alias("without_ts")).first()
        if r.rows and r.rows == r.without_ts:
            raise ValueError(f"no row of {m.column} has a full timestamp: give base_date")
        if counts is not None:
            counts.update({m.column: r.rows, **({f"{m.column}_without_ts": r.without_ts} if r.without_ts else {})})
    path = f"{out_dir.rstrip('/')}/{output_name(team_no, job)}"
    write_result(pair_alerts(a, b, job), path)
    return path


def alerts_via_csv(spark: SparkSession, lineitem: DataFrame, job: PairJobSpec, fmt: str = "json",
                   work: str | None = None) -> DataFrame:
    """Run the file-based flow for one job and return the result CSV read back."""
    work = work or scratch_path(spark, f"via-csv-{job.label.lower()}")
    wide = stage_wide_csv(spark, lineitem, work)
    paths = ingest_to_csv(spark, wide, job, work, fmt)
    out = run_alert_job(spark, paths[job.first.column], paths[job.second.column], job, work)
    return read_result_csv(spark, out, result_schema(job.out_first, job.out_second, job.how))
