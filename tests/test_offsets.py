"""Gapless offsets over publications, group positions, ranges."""

from collections import defaultdict

from pyspark.sql import functions as F

from vigilo.sources.offsets import TopicLog


def feed(spark, n, tasks=5):
    topic = F.when(F.col("id") % 3 == 0, F.lit("a")).otherwise(F.lit("b"))        # two thirds on one topic
    return spark.range(0, n, numPartitions=tasks).select(topic.alias("topic"), F.col("id").cast("string").alias("value"))


def offsets(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.topic].append(r.offset)
    return {t: sorted(x) for t, x in out.items()}


def test_offsets_go_on_without_gaps(spark, tmp_dir):
    log = TopicLog(spark, f"{tmp_dir}/log", compact_every=2)
    assert log.end_offsets() == {}
    assert log.publish(feed(spark, 30)) == {"a": 10, "b": 20}
    first = {(r.topic, r.offset): r.value for r in log.messages.read().collect()}
    assert log.publish(feed(spark, 30, 3).unionByName(spark.createDataFrame([("c", "x"), (None, "lost")], "topic string, value string"))) == {"a": 20, "b": 40, "c": 1}
    log.publish(feed(spark, 0))
    assert log.publish(feed(spark, 3)) == {"a": 21, "b": 42, "c": 1}
    now = {(r.topic, r.offset): r.value for r in log.messages.read().collect()}
    assert first.items() <= now.items()                                            # earlier messages keep theirs
    assert offsets(log.messages.read()) == {"a": list(range(21)), "b": list(range(42)), "c": [0]}
    assert offsets(log.read({"b": (5, 8), "c": (0, 1), "none": (0, 9)})) == {"b": [5, 6, 7], "c": [0]}


def test_groups_resume_at_their_positions(spark, tmp_dir):
    log = TopicLog(spark, f"{tmp_dir}/log")
    log.publish(feed(spark, 30))
    new, position = log.poll("one", ("a", "b", "none"), most=7)
    assert offsets(new) == {"a": list(range(7)), "b": list(range(7))}
    again, _ = log.poll("one", ("a", "b"), most=7)
    assert offsets(again) == offsets(new)                                          # not taken yet
    log.take("one", position)
    log.publish(feed(spark, 30))
    rest, position = TopicLog(spark, f"{tmp_dir}/log").poll("one", ("a", "b"))
    assert offsets(rest) == {"a": list(range(7, 20)), "b": list(range(7, 40))}
    log.take("one", position)
    assert log.position("one") == {"a": 20, "b": 40} and log.position("two") == {}
    assert offsets(log.poll("two", ("b",))[0]) == {"b": list(range(40))}           # another group starts at the beginning
    assert log.poll("one", ("a", "b"))[0].count() == 0


def test_no_task_numbers_a_topic(spark, tmp_dir):
    """The numbering window is dealt by topic and task, so a topic is spread over as many partitions as wrote it."""
    log = TopicLog(spark, f"{tmp_dir}/log")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")       # so little data would be put together
    try:
        log.publish(feed(spark, 3000, 8))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    tasks = log.messages.read().where("topic = 'b'").select(F.input_file_name().alias("f")).distinct().count()
    assert tasks > 1 and offsets(log.messages.read())["b"] == list(range(2000))
