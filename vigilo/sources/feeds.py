"""Message feeds derived from the driver's tables.

``wide_messages`` — the producer's output for the lineitem telemetry.
``event_feed`` — a realistic, dirty topic feed built from ``events``: varied
timestamp styles, empty objects, objects without the metric keys, numbers sent
as strings, JSON nulls and truncated (malformed) payloads, chosen by each
event's own fields so the mix grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import METRICS
from ..operators.messages import split_wide
from .telemetry import wide_text

# Fixed timestamp text styles used for the event feed, selected by event_id % 7.
TS_STYLES = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    "yyyy-MM-dd'T'HH:mm:ss'+05:30'",
    "HH:mm:ss",
    "'  'yyyy-MM-dd HH:mm:ss.SSS' '",
    "H:mm:ss",
    "yyyy-MM-dd",
)


def styled_ts(ts: Column, selector: Column) -> Column:
    """``ts`` as text in one of ``TS_STYLES`` picked by ``selector`` (0..6)."""
    expr = None
    for i, fmt in enumerate(TS_STYLES):
        piece = F.date_format(ts, fmt)
        expr = F.when(selector == i, piece) if expr is None else expr.when(selector == i, piece)
    return expr


# Fixed spellings of falsy JSON values, which the consumers skip, selected by user_id / 3 % 8.
FALSY = ("{}", "[ ]", "0.00", "-0.0", "0e5", "\n[]", " false", "{ }")


def wide_messages(lineitem: DataFrame, fmt: str = "json") -> DataFrame:
    return split_wide(wide_text(lineitem), fmt)


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def event_feed(events: DataFrame) -> DataFrame:
    """Kafka-shaped ``topic, value, offset, timestamp`` rows, one per event.

    topic = the four metric topics by ``event_id % 4``; the payload by event type:
    click → normal object with a JSON number; view → one of ``FALSY`` when ``user_id % 3 = 0``
    else normal; signup → the event's ``props`` object (no metric keys);
    purchase → number sent as a string when ``user_id`` is even, else JSON null;
    error → by ``user_id % 4`` the normal object cut short by one character, with text behind it, in
    single quotes (all malformed), or with the number as text with a type letter (``"1.5f"``, a bad number).
    Clicks of ``user_id % 7`` 0 and 1 carry the value times and divided by a million; those of 2 hold each key twice, other
    values first; those of 3 have a list as their server.

    Built in staged projections (key names, value text, object) so that no
    expression is repeated inside another.
    """
    eid, uid, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    idx = (eid % len(METRICS) + 1).cast("int")
    df = events.select(
        eid.alias("offset"), uid, etype, F.col("props"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.element_at(F.array(*[F.lit(m.topic) for m in METRICS]), idx).alias("topic"),
        F.element_at(F.array(*[F.lit(m.column) for m in METRICS]), idx).alias("_key"),
        F.element_at(F.array(*[F.lit(m.extra_columns[0] if m.extra_columns else None) for m in METRICS]),
                     idx).alias("_key2"),
        styled_ts(F.col("ts"), eid % len(TS_STYLES)).alias("_ts"),
        F.concat(F.lit("user-"), uid.cast("string")).alias("_server"),
        F.when((etype == "click") & (uid % 7 == 0), F.col("value") * 1e6)
         .when((etype == "click") & (uid % 7 == 1), F.col("value") / 1e6)
         .otherwise(F.col("value")).cast("string").alias("_num"),
    )
    num = F.col("_num")
    v = (F.when((etype == "error") & (uid % 4 == 3), _quoted(F.concat(num, F.lit("f"))))
         .when(etype != "purchase", num)
         .when(uid % 2 == 0, _quoted(num))
         .otherwise(F.lit("null")))
    df = df.withColumn("_v", v)
    listed = F.concat(F.lit("["), _quoted(F.col("_server")), F.lit(', {"a": 1.50, "b": null}, true]'))
    server = F.when((etype == "click") & (uid % 7 == 3), listed).otherwise(_quoted(F.col("_server")))
    twice = F.concat(F.lit('{"ts":"x","server_id":null,"'), F.col("_key"), F.lit('":-1,"ts":'))
    obj = F.concat(
        F.when((etype == "click") & (uid % 7 == 2), twice).otherwise(F.lit('{"ts":')), _quoted(F.col("_ts")),
        F.lit(',"server_id":'), server,
        F.lit(',"'), F.col("_key"), F.lit('":'), F.col("_v"),
        F.coalesce(F.concat(F.lit(',"'), F.col("_key2"), F.lit('":'), F.col("_v")), F.lit("")),
        F.lit("}"))
    df = df.withColumn("_obj", obj)
    o = F.col("_obj")
    value = (F.when(etype == "view", F.when(uid % 3 == 0, F.element_at(
                F.array(*map(F.lit, FALSY)), (F.floor(uid / 3) % len(FALSY) + 1).cast("int"))).otherwise(o))
             .when(etype == "signup", F.col("props"))
             .when((etype == "error") & (uid % 4 == 0), F.expr("substring(_obj, 1, length(_obj) - 1)"))
             .when((etype == "error") & (uid % 4 == 1), F.concat(o, F.lit(" trailing")))
             .when((etype == "error") & (uid % 4 == 2), F.replace(o, F.lit('"'), F.lit("'")))
             .otherwise(o))
    return df.select("topic", value.alias("value"), "offset", "timestamp")
