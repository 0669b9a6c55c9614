"""Time column expressions (all built-in, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Characters Python's str.strip() removes from ASCII text (space, \t, \n, \v, \f, \r, \x1c to \x1f).
_WS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"


def _strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_WS))


def _drop_one_z(c: Column) -> Column:
    """Remove one trailing ``Z``."""
    return F.when(F.endswith(c, F.lit("Z")), F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c)


def _count_char(c: Column, ch: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def normalise_hms(raw: Column | str) -> Column:
    """Normalise timestamp text to ``HH:MM:SS`` the way the ingest consumers do.

    Trim; text of 8 characters with two colons is kept; otherwise take the part
    after the last ``T`` (or, without a ``T``, after the last space), drop one
    trailing ``Z``, cut at the first ``.`` and then at the first ``+``; a part
    with at least 8 characters and two colons gives its first 8 characters,
    anything else returns the trimmed text unchanged. NULL stays NULL.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    t = _strip(raw)
    after = (F.when(F.contains(t, F.lit("T")), F.substring_index(t, "T", -1))
             .when(F.contains(t, F.lit(" ")), F.substring_index(t, " ", -1))
             .otherwise(t))
    part = F.substring_index(F.substring_index(_drop_one_z(after), ".", 1), "+", 1)
    return (F.when((F.length(t) == 8) & (_count_char(t, ":") == 2), t)
            .when((F.length(part) >= 8) & (_count_char(part, ":") >= 2), F.substring(part, 1, 8))
            .otherwise(t))


def with_normalised_hms(df, src: str, dst: str):
    """``df`` plus ``dst`` = ``normalise_hms(src)``, computed in staged projections.

    Same rule as ``normalise_hms``; the trimmed text and the candidate time part
    are materialised as intermediate columns so each string function runs once
    per row even where the surrounding projection cannot be code-generated.
    """
    t = _strip(F.col(src))
    df = df.withColumn("_hms_t", t)
    t = F.col("_hms_t")
    after = (F.when(F.contains(t, F.lit("T")), F.substring_index(t, "T", -1))
             .when(F.contains(t, F.lit(" ")), F.substring_index(t, " ", -1))
             .otherwise(t))
    df = df.withColumn("_hms_a", after)
    df = df.withColumn("_hms_p", F.substring_index(F.substring_index(
        _drop_one_z(F.col("_hms_a")), ".", 1), "+", 1))
    p = F.col("_hms_p")
    out = (F.when((F.length(t) == 8) & (_count_char(t, ":") == 2), t)
           .when((F.length(p) >= 8) & (_count_char(p, ":") >= 2), F.substring(p, 1, 8))
           .otherwise(t))
    return df.withColumn(dst, out).drop("_hms_t", "_hms_a", "_hms_p")


def hms(ts: Column | str) -> Column:
    """Format a timestamp as ``HH:mm:ss`` in the session time zone."""
    return F.date_format(ts, "HH:mm:ss")


def slide_index(ts: Column | str, slide_s: int) -> Column:
    """Index of the slide-aligned bucket holding ``ts`` (floor of epoch / slide)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(ts) / F.lit(slide_s * 1_000_000)).cast("long")


def index_to_ts(idx: Column | str, slide_s: int) -> Column:
    """Start timestamp of slide bucket ``idx``."""
    idx = F.col(idx) if isinstance(idx, str) else idx
    return F.timestamp_seconds(idx * F.lit(slide_s))


def floor_to_slide(ts: Column | str, slide_s: int) -> Column:
    """Timestamp floored to the slide, microseconds dropped."""
    return index_to_ts(slide_index(ts, slide_s), slide_s)


def parse_ts_text(text: Column | str, base_date: str | None = None) -> Column:
    """Best-effort full timestamp from message text.

    Full ISO/space forms parse as the clock time they show: a zone or offset
    behind it is left out, as ``normalise_hms`` leaves it out, so windows and
    message times agree. Bare ``HH:mm:ss`` text is placed on ``base_date`` when
    one is given and is NULL otherwise: a time alone never picks up the current date.
    """
    text = F.col(text) if isinstance(text, str) else text
    t = _strip(text)
    t = F.when(F.length(t) == 19, t).otherwise(F.regexp_replace(t, r"(:\d{2}(?:\.\d*)?) ?(?:Z|UTC|[+-]\d{2}:?\d{2})$", "$1"))
    # Only text that carries a date parses as a full timestamp; a bare time
    # would otherwise silently pick up today's date.
    has_date = F.substring(t, 1, 4).try_cast("int").isNotNull() & (F.substring(t, 5, 1) == F.lit("-"))
    full = F.when(has_date, F.try_to_timestamp(t))
    if base_date is None:
        return full
    bare = F.try_to_timestamp(F.concat(F.lit(base_date + " "), t), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.coalesce(full, bare)
