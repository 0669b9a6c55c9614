"""Decoded messages against Python's own json and float, over generated messages.

Left out, as listed in the README: digits beyond ASCII in numbers, non-printable characters beyond ASCII and the words NaN
and Infinity inside lists and objects, the smallest denormal numbers as text, repeated keys inside an object, integers too large for a float, and strings that spell
a number, a truth value or a list in messages with repeated keys.
"""

import json
import random

import pytest

from vigilo.config import METRIC_BY_TOPIC
from vigilo.operators.messages import decode_messages, with_status

BAD = "bad"


def value(rng, depth=0):
    kinds = ["int", "float", "text", "word", "null", "number text"] + (["list", "object"] if depth < 3 else [])
    kind = rng.choice(kinds)
    if kind == "int":
        return str(rng.choice((0, 1, -5, 95, 10 ** 12, 2 ** 63, -0, 12345678901234567890)))
    if kind == "float":
        return rng.choice(("0.0", "1.50", "-2.25", "1e5", "1E-7", "3.0E+20", "95.65", "0.1", "1e16", "123456789.125", "1e-300", "-0.0", "1e-5"))
    if kind == "text":
        return json.dumps(rng.choice(("srv-1", "it's", 'say "x"', "a\\b", "tab\tnl\n", "é☃", "", "2024-01-01T10:20:30Z", "\x01\x1f\x0b\x08\x0c\x7f", "'\"",
                                      "[1]", "{}", "null", "None", "a,b:c", "10:20:30")), ensure_ascii=rng.random() < 0.5)
    if kind == "word":
        return rng.choice(("true", "false"))
    if kind == "null":
        return "null"
    if kind == "number text":
        return json.dumps(rng.choice(("5", "1.5", "1e5", " 7 ", "1_000", "1__0", "0x1p3", "1.5f", "2d", "nan", "-Infinity", "+3", ".5", "5.", "true", "1e400", "--1", "")))
    gap = rng.choice(("", " "))
    if kind == "list":
        return "[" + ("," + gap).join(value(rng, depth + 1) for _ in range(rng.randint(0, 3))) + "]"
    return "{" + ("," + gap).join(json.dumps(k) + ":" + gap + value(rng, depth + 1) for k in rng.sample(("a", "b c", "k'"), rng.randint(0, 2))) + "}"


def message(rng, topic):
    m = METRIC_BY_TOPIC[topic]
    whole = rng.random()
    if whole < 0.12:
        return rng.choice(("[]", "[ ]", " [\n]", "{}", "{ }", "0", "0.00", "-0.0", "0e5", "\n[]", "\t0\n", "-0", "0E-3", "null", " false", '""', '" "', "[0]", "1",
                           "00", "0.", "[", "nul", "1e-400", "true", "{} x", "", "NaN", "-", "[,]", "{\"a\":}"))
    keys = ["ts", "server_id", m.column, *m.extra_columns, "other"]
    fields = [(k, value(rng)) for k in keys if rng.random() < 0.9]
    if rng.random() < 0.3 and fields:                       # repeated keys, with values that read one way only
        plain = lambda: rng.choice(("1", "2.5", "null", '"srv-2"', '"10:20:30"', "[1, 2.50]", '{"a": null}'))
        fields = [(k, plain()) for k, _ in fields]
        for _ in range(rng.randint(1, 2)):
            fields.insert(rng.randint(0, len(fields)), (rng.choice(fields)[0], plain()))
    gap = rng.choice(("", " ", "\n"))
    text = "{" + ",".join(f"{gap}{json.dumps(k)}{gap}:{gap}{v}" for k, v in fields) + gap + "}"
    return text[:-1] if rng.random() < 0.03 else text


def python(topic, text):
    """(skipped, reason's kind, ts text, server, figures) as the consumers' Python gets them."""
    m = METRIC_BY_TOPIC[topic]
    try:
        v = json.loads(text)
    except ValueError:
        return "malformed"
    if not v:
        return "skipped"
    if not isinstance(v, dict):
        return "malformed"
    try:
        figures = [float(v.get(c, 0)) for c in (m.column, *m.extra_columns)]
    except (TypeError, ValueError):
        return BAD
    return str(v.get("ts", "")), str(v.get("server_id", "")), *[repr(x) for x in figures]


@pytest.mark.parametrize("seed", [1])
def test_ten_thousand_messages(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(10_000):
        topic = rng.choice(sorted(METRIC_BY_TOPIC))
        rows.append((topic, message(rng, topic), i))
    got = decode_messages(spark.createDataFrame(rows, "topic string, value string, offset long").repartition(8)).collect()
    by_id = {r.offset: r for r in got}
    assert len(got) == len(rows)
    wrong, seen = [], {}
    for topic, text, i in rows:
        r, want = by_id[i], python(topic, text)
        if r.skipped:
            have = "skipped"
        elif r.reason is not None:
            have = BAD if r.reason == "bad number" else "malformed"
        else:
            extra = METRIC_BY_TOPIC[topic].extra_columns
            have = (r.ts_text, r.server_id, repr(r.value), *([repr(r.value2)] if extra else []))
        seen[want if isinstance(want, str) else "accepted"] = seen.get(want if isinstance(want, str) else "accepted", 0) + 1
        if have != want:
            wrong.append((text, have, want))
    assert not wrong, (len(wrong), wrong[:12])
    assert min(seen.get(k, 0) for k in ("skipped", "malformed", BAD, "accepted")) > 200


def test_lookups_and_patterns_are_not_repeated(spark):
    msgs = spark.createDataFrame([("topic-cpu", "{}")], "topic string, value string")
    plan = with_status(decode_messages(msgs))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("array_position(") == 4 and plan.count("from_json(") == 1
    assert plan.count("RLIKE") <= 10
