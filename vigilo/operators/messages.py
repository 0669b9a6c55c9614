"""Producer and consumer message handling: split, encode, decode, classify.

``split_wide`` turns each wide record into four topic messages in one pass
(``inline`` of a 4-element array: no join, no union of four scans).
``decode_messages`` parses topic messages (JSON objects, or the producer's
comma-joined text) with the consumers' coercion rules and tags every message
as accepted, skipped (an empty JSON value, which the consumers ignore) or
rejected with a reason (what the consumers either print as invalid or crash
on). Batch and streaming use the very same functions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FIGURE_FORMAT, FIGURE_SEPARATOR, METRICS, STATUS_LINE_FORMAT, MetricSpec
from ..functions.metrics import double_text, format_columns, over_threshold, status_text
from ..functions.pyjson import is_falsy, nested_text, number, number_text
from ..functions.timefmt import parse_ts_text, with_normalised_hms

FORMATS = ("json", "csv")

# Put behind each message before the parse: it is found there only if the message is one whole JSON value.
_END = "$end"

REASON_MALFORMED = "malformed or not a JSON object"
REASON_BAD_NUMBER = "bad number"
REASON_FIELD_COUNT = "wrong field count"
REASON_NULL = "null message"


def _fields(m: MetricSpec) -> list[str]:
    return ["ts", "server_id", m.column, *m.extra_columns]


def _text_or_none(c: Column) -> Column:
    # Python formats a missing CSV cell (None) as the text "None".
    return F.coalesce(c, F.lit("None"))


def encode_value(m: MetricSpec, fmt: str) -> Column:
    """Message text of metric ``m`` built from wide-record columns."""
    if fmt == "csv":
        return F.concat_ws(",", *[_text_or_none(F.col(c)) for c in _fields(m)])
    if fmt == "json":
        return F.to_json(F.struct(*[F.col(c) for c in _fields(m)]), {"ignoreNullFields": "false"})
    raise ValueError(f"format must be one of {FORMATS}, got {fmt!r}")


def split_wide(wide: DataFrame, fmt: str = "json", metrics: Iterable[MetricSpec] = METRICS) -> DataFrame:
    """Four ``(topic, value)`` messages per wide record: cpu, memory, network, disk."""
    msgs = F.array(*[F.struct(F.lit(m.topic).alias("topic"), encode_value(m, fmt).alias("value"))
                     for m in metrics])
    return wide.select(F.inline(msgs))


def topic_counts(messages: DataFrame) -> DataFrame:
    """Messages per topic (the producer's sent-per-topic tally)."""
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


# --------------------------------------------------------------------------- decode

def _route(topic: Column, attr: str, metrics: Iterable[MetricSpec], cast=None) -> Column:
    """Per-topic constant (column name, threshold, ...) as a CASE over the topic."""
    expr = None
    for m in metrics:
        v = getattr(m, attr)
        v = F.lit(v if cast is None else cast(v))
        expr = F.when(topic == m.topic, v) if expr is None else expr.when(topic == m.topic, v)
    return expr


_PLAIN = ("ts", "server", "one", "two")      # fields of a message in the order in which the producer spells them
_MOST_PLAIN = 1_000_000      # bytes; longer messages go to the parser, which has bounds of its own


def _with_plain(messages: DataFrame, value: Column) -> DataFrame:
    """``_plain``: the message is letter for letter what ``encode_value`` writes for the texts ``_text_*`` of its fields.

    Then all fields are strings without escapes, each key is there once, and nothing is left to the parser. The texts are what
    lies between the quotes; the test is equality with the message put together again, and no character that JSON strings must escape.
    """
    df = messages.withColumns({f"_text_{k}": F.substring_index(F.substring_index(value, '"', 4 * i), '"', -1) for i, k in enumerate(_PLAIN, 1)})
    ts, server, one, two = (F.col(f"_text_{k}") for k in _PLAIN)
    second = F.col("_second")
    last = F.when(second.isNull(), F.lit("")).otherwise(F.concat(F.lit(',"'), second, F.lit('":"'), two, F.lit('"')))
    again = F.concat(F.lit('{"ts":"'), ts, F.lit('","server_id":"'), server, F.lit('","'), F.col("_first"), F.lit('":"'), one, F.lit('"'), last, F.lit("}"))
    texts = F.concat(ts, server, one, F.when(second.isNull(), F.lit("")).otherwise(two))
    unescaped = F.regexp_instr(texts, F.lit(r'["\x00-\x1f\\]')) == 0
    plain = (value == again) & (F.octet_length(value) < _MOST_PLAIN) & unescaped & F.is_valid_utf8(value)
    return df.withColumn("_plain", F.coalesce(plain, F.lit(False)))


def _with_object(messages: DataFrame, value: Column) -> DataFrame:
    """``_parsed``: top-level fields of a message that is one JSON object and nothing else, else NULL; NULL for ``_plain`` ones, too.

    One parse a message: the array is a column of its own that the next projection reads.
    """
    both = F.when(~F.col("_plain"), F.from_json(_wrapped(value), "array<map<string,string>>", {"allowSingleQuotes": "false"}))
    b = F.col("_both")
    whole = (F.size(b) == 2) & F.map_contains_key(F.get(b, F.lit(1)), F.lit(_END)) & F.is_valid_utf8(value)
    return messages.withColumn("_both", both).withColumn("_parsed", F.when(whole, F.get(b, F.lit(0)))).drop("_both")


def _wrapped(value: Column) -> Column:
    return F.concat(F.lit("["), value, F.lit(f',{{"{_END}":""}}]'))


def _with_json_fields(df: DataFrame, value: Column, metrics: tuple[MetricSpec, ...]) -> DataFrame:
    """The top-level fields that count, looked up once each: of repeated keys the last.

    ``_ts, _server, _one, _two``: the parser's text of the field (NULL: JSON null or missing), ``_at_*``: its place among
    the keys from the end, 0 where it is missing (``_plain`` messages aren't parsed: the texts between their quotes, and 1). ``_types``: JSON types by key, by a second parse that is made only
    for messages one of whose fields reads alike as a string and as something else. That parse takes no repeated
    keys; in messages with such, what reads like something else than a string counts as that.
    """
    topic = F.col("topic")
    extra = {m.topic: m.extra_columns[0] for m in metrics if m.extra_columns}
    second = F.lit(None).cast("string")
    for t, c in extra.items():
        second = F.when(topic == t, F.lit(c)).otherwise(second)
    df = df.withColumns({"_first": _route(topic, "column", metrics), "_second": second})
    df = _with_object(_with_plain(df, value), value)
    plain = F.col("_plain")
    df = df.withColumns({"_keys": F.reverse(F.map_keys("_parsed")), "_values": F.reverse(F.map_values("_parsed")),
                         "_n": F.when(plain, F.lit(3)).otherwise(F.size("_parsed"))})
    keys = {"ts": F.lit("ts"), "server": F.lit("server_id"), "one": F.col("_first"), "two": F.col("_second")}
    df = df.withColumns({f"_at_{k}": F.when(plain, F.lit(1)).otherwise(F.coalesce(F.array_position("_keys", c), F.lit(0)).cast("int")) for k, c in keys.items()})
    df = df.withColumns({f"_{k}": F.when(plain, F.col(f"_text_{k}")).otherwise(F.get("_values", F.col(f"_at_{k}") - 1)) for k in keys})

    def word_or_nested(c: str) -> Column:
        return F.col(c).isin("true", "false") | F.ascii(c).isin(34, 91, 123)       # a quote or an opening bracket

    def like_number(c: str) -> Column:
        return (F.ascii(c).between(48, 57) | (F.ascii(c) == 45)) & ~F.contains(c, F.lit(":"))
    unsure = (word_or_nested("_ts") | word_or_nested("_server") | word_or_nested("_one") | word_or_nested("_two")
              | like_number("_ts") | like_number("_server"))
    typed = F.try_variant_get(F.try_parse_json(value), "$", "map<string,variant>")
    df = df.withColumn("_unsure", F.when(plain, F.lit(False)).otherwise(F.coalesce(unsure, F.lit(False))))
    return df.withColumn("_types", F.when(F.col("_unsure"), F.transform_values(typed, lambda k, v: F.schema_of_variant(v))))


def _json_fields(value: Column) -> dict[str, Column]:
    def text(name: str, key: str) -> Column:
        # str(v.get(key, "")): missing -> "", JSON null -> "None", true/false -> "True"/"False", lists and objects as Python prints them
        raw, kind = F.col(f"_{name}"), F.element_at("_types", F.lit(key))
        other = (F.when(F.ascii(raw).isin(91, 123), nested_text(raw))
                 .when(raw.isin("true", "false"), F.initcap(raw))
                 .when((F.ascii(raw) == 34) | raw.try_cast("double").isNotNull(), number_text(raw)))
        return (F.when(F.col(f"_at_{name}") == 0, F.lit(""))
                .when(raw.isNull(), F.lit("None"))
                .when(~F.col("_unsure") | (kind == "STRING"), raw)
                .otherwise(F.coalesce(other, raw)))

    def figure(name: str, key: str) -> Column:
        # float(v.get(key, 0)): JSON true/false are 1.0/0.0, the words NaN and Infinity (in the parser's quotes) numbers
        raw, kind = F.col(f"_{name}"), F.element_at("_types", F.col(key))
        other = F.when(raw == "true", F.lit(1.0)).when(raw == "false", F.lit(0.0)).when(
            raw.isin('"NaN"', '"Infinity"', '"-Infinity"'), F.btrim(raw, F.lit('"')).try_cast("double"))
        return (F.when(F.col(f"_at_{name}") == 0, F.lit(0.0))
                .when(~F.col("_plain") & (raw.isin("true", "false") | (F.ascii(raw) == 34)), F.when(F.coalesce(kind != "STRING", F.lit(True)), other))
                .otherwise(number(raw)))

    return {"ts_text": text("ts", "ts"), "server_id": text("server", "server_id"), "value": figure("one", "_first"),
            "value2": F.when(F.col("_second").isNotNull(), figure("two", "_second")),
            "skip": F.coalesce(F.when(F.col("_n") >= 0, F.col("_n") == 0).otherwise(is_falsy(value)), F.lit(False))}


def _json_reason(value: Column) -> Column:
    bad = F.col("_f.value").isNull() | (F.col("_second").isNotNull() & F.col("_f.value2").isNull())
    return (F.when(value.isNull(), F.lit(REASON_NULL)).when(F.col("_f.skip"), F.lit(None))
            .when(F.col("_parsed").isNull() & ~F.col("_plain"), F.lit(REASON_MALFORMED)).when(bad, F.lit(REASON_BAD_NUMBER)))


def _csv_fields(value: Column, metrics: tuple[MetricSpec, ...]) -> dict[str, Column]:
    parts = F.col("_parsed")  # split(value, ","), computed once upstream
    want = _route(F.col("topic"), "extra_columns", metrics, cast=lambda ex: 3 + len(ex))
    return {"ts_text": F.get(parts, 0), "server_id": F.get(parts, 1), "value": number(F.get(parts, 2)),
            "value2": F.when(want == 4, number(F.get(parts, 3))), "skip": F.lit(False), "want": want}


def _csv_reason(value: Column) -> Column:
    return (F.when(value.isNull(), F.lit(REASON_NULL)).when(F.size("_parsed") != F.col("_f.want"), F.lit(REASON_FIELD_COUNT))
            .when(F.col("_f.value").isNull() | ((F.col("_f.want") == 4) & F.col("_f.value2").isNull()), F.lit(REASON_BAD_NUMBER)))


def decode_messages(messages: DataFrame, fmt: str = "json", metrics: Iterable[MetricSpec] = METRICS,
                    base_date: str | None = None) -> DataFrame:
    """Parse topic messages into one row each, accepted or not.

    Output: every input column (the raw ``value`` renamed ``message``), then ``metric, ts_text, ts, event_ts, server_id,
    value, value2, skipped, reason`` where ``ts`` is the ``HH:MM:SS`` text the
    consumers store, ``event_ts`` keeps the full timestamp when the text has a
    date (bare times use ``base_date`` or stay NULL), ``value2`` carries the
    second network figure, and ``reason`` is NULL for accepted rows.
    Messages on topics outside ``metrics`` are dropped, as the consumers ignore them.
    """
    metrics = tuple(metrics)
    topics = [m.topic for m in metrics]
    value = F.col("value").cast("string")
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, got {fmt!r}")
    df = messages.where(F.col("topic").isin(*topics))
    if fmt == "json":
        df = _with_json_fields(df, value, metrics)
        fields, reason = _json_fields(value), _json_reason(value)
    else:
        df = df.withColumn("_parsed", F.split(value, ",", -1))
        fields, reason = _csv_fields(value, metrics), _csv_reason(value)
    # Each figure is read once, into a struct; the reason reads that. A generator of one row behind it: conditions
    # on the decoded fields stay above, so nothing is parsed again to filter.
    df = df.withColumn("_f", F.struct(*[c.alias(n) for n, c in fields.items()]))
    row = F.struct(_route(F.col("topic"), "name", metrics).alias("metric"), F.col("_f.ts_text").alias("ts_text"),
                   F.col("_f.server_id").alias("server_id_"), F.col("_f.value").alias("value_"), F.col("_f.value2").alias("value2"),
                   F.col("_f.skip").alias("skipped"), reason.alias("reason"))
    df = df.select(*messages.columns, F.inline(F.array(row)))
    df = with_normalised_hms(df, "ts_text", "ts")
    df = df.withColumn("event_ts", parse_ts_text("ts_text", base_date))
    order = [c for c in messages.columns] + ["metric", "ts_text", "ts", "event_ts", "server_id_", "value_",
                                              "value2", "skipped", "reason"]
    return (df.select(*order)
            .withColumnRenamed("value", "message")
            .withColumnRenamed("server_id_", "server_id")
            .withColumnRenamed("value_", "value"))


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(~F.col("skipped") & F.col("reason").isNull())


def rejects(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNotNull())


def with_status(parsed: DataFrame, metrics: Iterable[MetricSpec] = METRICS) -> DataFrame:
    """Per-message alert flag, status text and the consumers' status line.

    ``is_alert`` is a strict ``value > threshold`` in double where NaN never
    alerts; ``status`` is ``<prefix><value>`` or ``OK``; ``line`` is e.g.
    ``[CPU] 10:20:30 | srv-1 | cpu_pct=95.5 | ⚠ CPU ALERT: 95.5``.
    """
    metrics = tuple(metrics)
    topic, v = F.col("topic"), F.col("value")
    thr = _route(topic, "threshold", metrics, cast=float)
    prefix = _route(topic, "status_prefix", metrics)
    col_name = _route(topic, "column", metrics)
    is_alert = over_threshold(v, thr)
    status = status_text(v, thr, prefix)
    figures = format_columns(FIGURE_FORMAT, name=col_name, value=double_text(v))
    extra = [(m.topic, m.extra_columns[0]) for m in metrics if m.extra_columns]
    for t, c in extra:
        second = format_columns(FIGURE_FORMAT, name=F.lit(c), value=double_text("value2"))
        figures = F.when(topic == t, F.concat(figures, F.lit(FIGURE_SEPARATOR), second)).otherwise(figures)
    line = format_columns(STATUS_LINE_FORMAT, metric=F.col("metric"), ts=F.col("ts"),
                          server_id=F.col("server_id"), figures=figures, status=status)
    return parsed.withColumns({"is_alert": is_alert, "status": status, "line": line})


def typed_table(parsed: DataFrame, metric: MetricSpec) -> DataFrame:
    """The per-topic table the consumers append to: ``ts, server_id, <value>[, net_out], event_ts``."""
    cols = [F.col("ts"), F.col("server_id"), F.col("value").alias(metric.column)]
    if metric.extra_columns:
        cols.append(F.col("value2").alias(metric.extra_columns[0]))
    cols.append(F.col("event_ts"))
    return parsed.where(F.col("topic") == metric.topic).select(*cols)
