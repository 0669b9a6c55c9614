"""Producer split, consumer decode rules, timestamp normalisation, status text, rejects."""

import pytest
from pyspark.sql import functions as F

from vigilo.config import CPU, MEM, METRICS, NET
from vigilo.functions.metrics import double_text
from vigilo.functions.timefmt import normalise_hms, parse_ts_text
from vigilo.operators.messages import (
    REASON_BAD_NUMBER, REASON_FIELD_COUNT, REASON_MALFORMED, accepted, decode_messages, rejects, split_wide,
    with_status,
)
from vigilo.schemas import WIDE_TEXT

# (input, expected) for the HH:MM:SS normalisation.
NORMALISE_CASES = [
    ("", ""), ("   ", ""), ("  10:20:30 ", "10:20:30"), ("\t10:20:30\n", "10:20:30"),
    ("2024-01-01T10:20:30Z", "10:20:30"), ("2024-01-01 10:20:30.123", "10:20:30"),
    ("2024-01-01T10:20:30+05:30", "10:20:30"), ("2024-01-01T10:20:30-05:00", "10:20:30"),
    ("2024-01-01 9:02:03", "2024-01-01 9:02:03"), ("9:02:03", "9:02:03"),
    ("2024-01-01 10:20:30 UTC", "2024-01-01 10:20:30 UTC"), ("10:20", "10:20"),
    ("2024-01-01", "2024-01-01"), ("None", "None"), ("a:b:cdef", "a:b:cdef"), ("10:20:30.5", "10:20:30"),
]


def test_normalise_hms_table(spark):
    df = spark.createDataFrame(NORMALISE_CASES, "raw string, want string")
    got = df.select("raw", "want", normalise_hms("raw").alias("got")).collect()
    assert [(r.raw, r.got) for r in got] == [(r.raw, r.want) for r in got]


def test_bare_time_needs_base_date(spark):
    df = spark.createDataFrame([("23:59:59",), ("00:00:01",), ("2024-01-02 03:04:05",)], "t string")
    no_base = [r[0] for r in df.select(parse_ts_text("t")).collect()]
    assert no_base[0] is None and no_base[1] is None and no_base[2] is not None
    based = [r[0] for r in df.select(parse_ts_text("t", "2024-03-01")).collect()]
    assert [d.strftime("%Y-%m-%d %H:%M:%S") for d in based[:2]] == ["2024-03-01 23:59:59", "2024-03-01 00:00:01"]


def _wide(spark, rows):
    return spark.createDataFrame(rows, WIDE_TEXT)


def test_split_wide_csv_and_json(spark):
    w = _wide(spark, [("2024-01-01 00:00:05", "s1", "1.5", "2.5", "3.5", "4.5", "5.5"),
                      ("2024-01-01 00:00:06", "s2", None, "2", "3", "4", "5")])
    csv = [tuple(r) for r in split_wide(w, "csv").collect()]
    assert csv[:4] == [("topic-cpu", "2024-01-01 00:00:05,s1,1.5"), ("topic-mem", "2024-01-01 00:00:05,s1,2.5"),
                       ("topic-net", "2024-01-01 00:00:05,s1,3.5,4.5"), ("topic-disk", "2024-01-01 00:00:05,s1,5.5")]
    assert csv[4] == ("topic-cpu", "2024-01-01 00:00:06,s2,None")
    js = [tuple(r) for r in split_wide(w, "json").collect()]
    assert js[0] == ("topic-cpu", '{"ts":"2024-01-01 00:00:05","server_id":"s1","cpu_pct":"1.5"}')
    assert js[4] == ("topic-cpu", '{"ts":"2024-01-01 00:00:06","server_id":"s2","cpu_pct":null}')


def _decode(spark, rows, fmt="json"):
    msgs = spark.createDataFrame(rows, "topic string, value string")
    return decode_messages(msgs, fmt).orderBy("message")


def test_json_decode_rules(spark):
    rows = [
        ("topic-cpu", '{"ts": "2024-01-01T10:20:30Z", "server_id": "a", "cpu_pct": 95.5}'),  # alert
        ("topic-cpu", '{"other": 1}'),                  # processed with defaults
        ("topic-cpu", "{}"),                            # skipped
        ("topic-cpu", "[]"),                            # skipped (falsy)
        ("topic-cpu", "not json"),                      # rejected
        ("topic-cpu", "[1]"),                           # rejected (not an object)
        ("topic-cpu", '{"cpu_pct": null}'),             # rejected: bad number
        ("topic-cpu", '{"cpu_pct": "abc"}'),            # rejected: bad number
        ("topic-mem", '{"ts": null, "server_id": "b", "mem_pct": "12.5"}'),   # ts None, numeric string ok
        ("topic-net", '{"ts": "10:20:30", "server_id": "c", "net_in": 7205.16}'),  # equal: no alert
        ("topic-other", '{"ts": "x"}'),                 # unknown topic ignored
        ("topic-disk", '{"disk_io": true}'),            # JSON boolean reads as 1.0
        ("topic-disk", '{"disk_io": "true"}'),          # the string "true" is a bad number
        ("topic-mem", '{"ts": true, "server_id": "false", "mem_pct": 1}'),   # str(True) -> "True"
    ]
    d = _decode(spark, rows)
    assert d.count() == 13
    ok = {r.message: r for r in with_status(accepted(d)).collect()}
    r = ok['{"ts": "2024-01-01T10:20:30Z", "server_id": "a", "cpu_pct": 95.5}']
    assert (r.ts, r.server_id, r.value, r.is_alert, r.status) == ("10:20:30", "a", 95.5, True, "⚠ CPU ALERT: 95.5")
    assert r.line == "[CPU] 10:20:30 | a | cpu_pct=95.5 | ⚠ CPU ALERT: 95.5"
    r = ok['{"other": 1}']
    assert (r.ts, r.server_id, r.value, r.status) == ("", "", 0.0, "OK")
    r = ok['{"ts": null, "server_id": "b", "mem_pct": "12.5"}']
    assert (r.ts, r.value) == ("None", 12.5)
    r = ok['{"ts": "10:20:30", "server_id": "c", "net_in": 7205.16}']
    assert (r.value, r.value2, r.is_alert) == (7205.16, 0.0, False)
    assert r.line == "[NET] 10:20:30 | c | net_in=7205.16 | net_out=0.0 | OK"
    assert ok['{"disk_io": true}'].value == 1.0
    r = ok['{"ts": true, "server_id": "false", "mem_pct": 1}']
    assert (r.ts_text, r.server_id) == ("True", "false")
    rej = {r.message: r.reason for r in rejects(d).collect()}
    assert rej == {"not json": REASON_MALFORMED, "[1]": REASON_MALFORMED,
                   '{"cpu_pct": null}': REASON_BAD_NUMBER, '{"cpu_pct": "abc"}': REASON_BAD_NUMBER,
                   '{"disk_io": "true"}': REASON_BAD_NUMBER}
    skipped = {r.message for r in d.where("skipped").collect()}
    assert skipped == {"{}", "[]"}


def test_nan_never_alerts_in_ingest(spark):
    d = _decode(spark, [("topic-cpu", '{"cpu_pct": "NaN"}')])
    r = with_status(accepted(d)).collect()[0]
    assert r.is_alert is False and r.status == "OK"


def test_csv_decode_rules(spark):
    rows = [("topic-cpu", "2024-01-01 00:00:05,s1,91.5"), ("topic-net", "2024-01-01 00:00:05,s1,1.0,2.0"),
            ("topic-net", "2024-01-01 00:00:05,s1,1.0"), ("topic-disk", "t,s,abc"), ("topic-mem", "t,s,1,2")]
    d = _decode(spark, rows, "csv")
    ok = {r.message: r for r in accepted(d).collect()}
    assert ok["2024-01-01 00:00:05,s1,91.5"].ts == "00:00:05"
    assert ok["2024-01-01 00:00:05,s1,1.0,2.0"].value2 == 2.0
    rej = {r.message: r.reason for r in rejects(d).collect()}
    assert rej == {"2024-01-01 00:00:05,s1,1.0": REASON_FIELD_COUNT, "t,s,abc": REASON_BAD_NUMBER,
                   "t,s,1,2": REASON_FIELD_COUNT}


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_round_trip_split_decode(spark, fmt):
    w = _wide(spark, [("2024-01-01 00:00:05", "s1", "1.50", "2.25", "3", "4", "5.75")])
    d = accepted(decode_messages(split_wide(w, fmt), fmt)).orderBy("topic")
    got = {r.topic: (r.ts, r.server_id, r.value, r.value2) for r in d.collect()}
    assert got == {"topic-cpu": ("00:00:05", "s1", 1.5, None), "topic-mem": ("00:00:05", "s1", 2.25, None),
                   "topic-net": ("00:00:05", "s1", 3.0, 4.0), "topic-disk": ("00:00:05", "s1", 5.75, None)}
    full = d.select("event_ts").distinct().collect()
    assert len(full) == 1 and full[0][0].strftime("%Y-%m-%d %H:%M:%S") == "2024-01-01 00:00:05"


def test_consumer_subset_ignores_other_topics(spark):
    msgs = spark.createDataFrame([("topic-cpu", '{"cpu_pct": 1}'), ("topic-net", '{"net_in": 1}')],
                                 "topic string, value string")
    d = decode_messages(msgs, "json", (CPU, MEM))
    assert [r.topic for r in d.collect()] == ["topic-cpu"]
    assert len(METRICS) == 4 and NET.extra_columns == ("net_out",)


def test_only_one_whole_json_object_counts(spark):
    bad = ['{"cpu_pct": 95} trailing', '{"cpu_pct": 95}}', "{'cpu_pct': 95}", '{"cpu_pct": 95},{"a":1}', '{"cpu_pct": 95}]', ""]
    d = _decode(spark, [("topic-cpu", x) for x in bad])
    assert {r.message: r.reason for r in d.collect()} == {x: REASON_MALFORMED for x in bad}
    broken = spark.sql("select 'topic-cpu' as topic, cast(X'7B227365727665725F6964223A22FF227D' as string) as value")
    assert decode_messages(broken).collect()[0].reason == REASON_MALFORMED


def test_numbers_are_those_of_python(spark):
    text = ["1.5f", "1.5d", "0x1p3", "1__0", "_1", "1_0.5", " inf ", "-Infinity", "+1.", ".5", "1e3", "\"5\"", "", "NaN"]

    def value(x):
        try:
            return repr(float(x))
        except ValueError:
            return None
    import json
    d = _decode(spark, [("topic-cpu", json.dumps({"server_id": x, "cpu_pct": x})) for x in text])
    got = {r.server_id: None if r.reason else repr(r.value) for r in d.collect()}
    assert got == {x: value(x) for x in text}
    words = _decode(spark, [("topic-cpu", f'{{"cpu_pct": {x}}}') for x in ("NaN", "Infinity", "1e400")])
    assert [r.reason for r in words.collect()] == [None] * 3


def test_number_text_is_pythons(spark):
    values = [1.5, 12345678.5, 0.0005, 1e-4, 9.9e-5, 1e16, 1.5e16, 123456789012345.6, -1e7, 1e22, float("nan"), float("inf"),
              float("-inf"), 0.0, -0.0, 1e300, 0.001, 1234567890123456.0, None]
    rows = spark.createDataFrame([(x,) for x in values], "v double").select("v", double_text("v").alias("t")).collect()
    assert [r.t for r in rows] == [None if r.v is None else repr(r.v) for r in rows]


def test_decode_parses_once(spark):
    msgs = spark.createDataFrame([("topic-cpu", '{"cpu_pct": 1}')], "topic string, value string")
    plan = with_status(accepted(decode_messages(msgs)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_offset_is_left_out_of_both_times(spark):
    d = _decode(spark, [("topic-cpu", '{"ts": "2024-01-01T10:20:30+05:30", "cpu_pct": 1}')]).collect()[0]
    assert (d.ts, d.event_ts.strftime("%H:%M:%S")) == ("10:20:30", "10:20:30")


def test_status_columns_with_f_lit(spark):
    msgs = spark.createDataFrame([("topic-disk", '{"disk_io": 4220.25}')], "topic string, value string")
    r = with_status(accepted(decode_messages(msgs))).select("status", F.col("line")).collect()[0]
    assert r.status == "⚠ DISK_IO ALERT: 4220.25"
    assert r.line == "[DISK]  |  | disk_io=4220.25 | ⚠ DISK_IO ALERT: 4220.25"
