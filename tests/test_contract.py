"""Driver contract: entry, registered queries and oracle keys; quick oracle checks at sf0.001."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import _rows

FAST = ["cpu_mem_alerts", "net_disk_alerts", "window_spine", "decode_messages_csv", "event_feed_decode",
        "ingest_rejects", "normalise_ts", "alert_summary"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["server_id", "window_start", "window_end", "avg_cpu", "avg_mem", "alert"]
    assert df.count() == 610


def test_oracle_keys_subset_of_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 25


@pytest.fixture(scope="module")
def duck():
    from conftest import SF_SMALL
    con = duckdb.connect()
    for t in ("lineitem", "events"):
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    con.execute("set TimeZone='UTC'")
    return con


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle_small(spark, duck, name):
    from conftest import SF_SMALL
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    s, sn = _rows(df.columns, [tuple(r) for r in df.collect()])
    d, dn = _rows(rel.columns, rel.fetchall())
    assert sn == dn
    assert s == d


def test_base_queries_without_numpy_or_the_training_data_folder():
    """A missing dependency, or a left-over empty folder, costs the training-data queries only."""
    code = ("import sys; sys.modules['%s'] = None; sys.path.insert(0, %r); import __spark_entry__ as e; "
            "q = e.queries(); assert 'cpu_mem_alerts' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q); print(len(q))")
    root = os.path.dirname(os.path.abspath(E.__file__))
    for missing in ("numpy", "vigilo.llm.registry"):
        out = subprocess.run([sys.executable, "-c", code % (missing, root)], capture_output=True, text=True, cwd="/")
        assert out.returncode == 0 and int(out.stdout) >= 34, out.stderr[-500:]
