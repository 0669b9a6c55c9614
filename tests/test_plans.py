"""Plan shape of every registered batch query: no cross products, no Python in the plan,
aggregates split into partial + final, filters and pruning reaching the scans."""

import pytest

from vigilo.plans.registry import all_queries
from conftest import SF_SMALL

# Streaming runs stage files and start queries; their batch reads are covered by the others.
SKIP = {n for n in all_queries() if n.startswith("stream_")}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(all_queries()) - SKIP))
def test_plan_shape(spark, name):
    df = all_queries()[name](spark, SF_SMALL)
    df.collect()                              # final adaptive plan
    plan = _plan(df)
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad} in plan"
    if "HashAggregate" in plan and "Exchange hashpartitioning" in plan:
        assert "partial_" in plan, f"{name}: aggregation without map-side partial step"


def test_scan_prunes_columns(spark):
    df = all_queries()["cpu_mem_joined"](spark, SF_SMALL)
    plan = _plan(df)
    schemas = [line.split("ReadSchema: ")[1] for line in plan.split("\n") if "ReadSchema: " in line]
    assert schemas and all("l_extendedprice" not in s and "l_shipdate" not in s for s in schemas)


def test_topic_partition_pruning(spark, tmp_dir):
    from vigilo.operators.messages import split_wide
    from vigilo.sources.files import publish_messages, read_messages
    from vigilo.sources.telemetry import read_table, wide_text
    publish_messages(split_wide(wide_text(read_table(spark, SF_SMALL, "lineitem")), "csv"), tmp_dir)
    df = read_messages(spark, tmp_dir, ["topic-cpu"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan and "topic-cpu" in plan
    assert {r.topic for r in df.select("topic").distinct().collect()} == {"topic-cpu"}


def test_spread_only_when_asked(spark):
    from vigilo.sources.telemetry import spread
    df = spark.range(10)
    assert spread(df, None) is df
    assert spread(df, 3).rdd.getNumPartitions() == 3


def test_cluster_needs_a_shared_folder():
    import types

    from vigilo.session import shared_dir
    context = types.SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError):
        shared_dir(types.SimpleNamespace(conf={}, sparkContext=context))


def test_window_shorter_than_slide_is_refused():
    from vigilo.config import WindowSpec
    with pytest.raises(ValueError):
        WindowSpec(length_s=10, slide_s=20).validate()
