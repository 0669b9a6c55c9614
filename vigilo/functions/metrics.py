"""Metric value and alert column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import STATUS_OK, PairJobSpec


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2_float(c: Column | str) -> Column:
    """Cast to float32 then round to 2 decimals (HALF_UP), as the batch jobs load values."""
    return F.round(_c(c).cast("float"), 2)


def over_threshold(c: Column | str, threshold: float | Column) -> Column:
    """Strict ``value > threshold`` in double precision where NaN never alerts.

    This is the per-message (ingest) rule: plain Python float comparison.
    ``threshold`` may be a column (e.g. chosen per topic).
    """
    v = _c(c).cast("double")
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.coalesce(~F.isnan(v) & (v > t), F.lit(False))


def pair_alert(a: Column | str, b: Column | str, job: PairJobSpec) -> Column:
    """Three-branch alert CASE without ELSE: no branch (or a NULL side) gives NULL.

    The rounded aggregate is compared, against the threshold as a double, with
    Spark's own comparison rules (NaN is larger than any number).
    """
    a, b = _c(a).cast("double"), _c(b).cast("double")
    ta, tb = F.lit(float(job.first.threshold)), F.lit(float(job.second.threshold))
    return (F.when((a > ta) & (b > tb), F.lit(job.alert_both))
            .when((a > ta) & (b <= tb), F.lit(job.alert_first))
            .when((b > tb) & (a <= ta), F.lit(job.alert_second)))


def double_text(c: Column | str) -> Column:
    """Text of a double as Python prints a float.

    Plain digits from 1e-4 up to 1e16, beyond that ``1.5e+16`` / ``1.5e-05``; ``nan``, ``inf``, ``-inf``.
    """
    v = _c(c).cast("double")
    text = v.cast("string")
    # 22 places hold every digit of a double from 1e-4 on, 16 digits before the point all below 1e16
    digits = F.rtrim(v.try_cast("decimal(38,22)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1)
    size = F.lpad(F.ltrim(power, F.lit("-")), 2, "0")
    size = F.when(F.length(power) > F.length(size), F.ltrim(power, F.lit("-"))).otherwise(size)
    scientific = F.concat(mantissa, F.when(F.startswith(power, F.lit("-")), F.lit("e-")).otherwise(F.lit("e+")), size)
    return (F.when(F.isnan(v), F.lit("nan"))
            .when(F.abs(v) == float("inf"), F.when(v > 0, F.lit("inf")).otherwise(F.lit("-inf")))
            .when(~F.contains(text, F.lit("E")), text)
            .when((F.abs(v) >= 1e-4) & (F.abs(v) < 1e16), plain)
            .otherwise(scientific))


def status_text(c: Column | str, threshold: float | Column, prefix: str | Column) -> Column:
    """``<prefix><value>`` when the value is over the threshold, else ``OK``."""
    p = prefix if isinstance(prefix, Column) else F.lit(prefix)
    return F.when(over_threshold(c, threshold), F.concat(p, double_text(c))).otherwise(F.lit(STATUS_OK))


def format_columns(fmt: str, **cols: Column) -> Column:
    """``fmt`` with each ``{name}`` replaced by the matching column (text concat, JVM side)."""
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", fmt)):
        if i % 2:
            parts.append(cols[piece])
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)
