"""DuckDB SQL that states each registered query's expected result independently.

These texts follow the monitored jobs literally (pair join, range join against
a spine of window starts, CASE without ELSE) rather than our Spark plan, so
the side-by-side check exercises the rewrite. Rounding follows Spark: a double
is rounded HALF_UP on its shortest decimal text, so the oracle goes through
``varchar`` and ``decimal`` before ``round``.
"""

from __future__ import annotations

from typing import NamedTuple

# ---------------------------------------------------------------------------
# Fixed values, written out here and not taken from the configuration, so that
# a wrong value there shows as a difference.
# ---------------------------------------------------------------------------
FIXTURE_EPOCH = 1704067205     # 2024-01-01 00:00:05 UTC
FIXTURE_TICKS = 600
WINDOW_SECONDS = 30
SLIDE_SECONDS = 10
CPU_THRESHOLD = 89.65
MEM_THRESHOLD = 89.73
NET_IN_THRESHOLD = 7205.16
DISK_IO_THRESHOLD = 4220.24
ALERT_CPU_MEM_BOTH = "High CPU + Memory stress"
ALERT_CPU_ONLY = "CPU spike suspected"
ALERT_MEM_ONLY = "Memory saturation suspected"
ALERT_NET_DISK_BOTH = "Network flood + Disk thrash suspected"
ALERT_NET_ONLY = "Possible DDoS"
ALERT_DISK_ONLY = "Disk thrash suspected"
STATUS_OK = "OK"
CONSUMER_GROUP_CPU_MEM = "consumer1-cpu-mem"
CONSUMER_GROUP_NET_DISK = "consumer2-net-disk"


class _Metric(NamedTuple):
    name: str
    topic: str
    column: str
    threshold: float
    status_prefix: str
    extra_columns: tuple = ()


METRICS = (
    _Metric("CPU", "topic-cpu", "cpu_pct", CPU_THRESHOLD, "⚠ CPU ALERT: "),
    _Metric("MEM", "topic-mem", "mem_pct", MEM_THRESHOLD, "⚠ MEM ALERT: "),
    _Metric("NET", "topic-net", "net_in", NET_IN_THRESHOLD, "⚠ NET_IN ALERT: ", ("net_out",)),
    _Metric("DISK", "topic-disk", "disk_io", DISK_IO_THRESHOLD, "⚠ DISK_IO ALERT: "),
)
# ---------------------------------------------------------------------------


def r2d(x: str) -> str:
    """Spark ``round(double, 2)``."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,18)), 2) as double)"


def r2f(x: str) -> str:
    """Spark ``round(float, 2)``: HALF_UP on the text of the value widened to double."""
    return f"cast(round(cast(cast(cast({x} as double) as varchar) as decimal(38,18)), 2) as float)"


def dbl(x) -> str:
    return f"cast({x} as double)"


# servers of every fifth supplier are silent for a minute: their samples of that minute carry the minute before
TICK = (f"(l_orderkey % {FIXTURE_TICKS} - case when l_suppkey % 5 = 0 and "
        f"l_orderkey % {FIXTURE_TICKS} between 300 and 359 then 60 else 0 end)")
TS = f"make_timestamp(({FIXTURE_EPOCH} + {TICK}) * 1000000)"
SERVER = "concat('srv-', cast(l_suppkey as varchar))"

TELEMETRY = f"""
telemetry as (
  select {TS} as ts,
    {SERVER} as server_id,
    cast(case when l_suppkey % 2 = 0 then 80 + l_quantity*0.4 else l_quantity end as float) as cpu_pct,
    cast(case when l_suppkey % 3 = 0 then 80 + (l_partkey % 50)*0.4 else (l_partkey % 80) end as float) as mem_pct,
    cast(l_extendedprice/14 as float) as net_in,
    cast(l_extendedprice/20 as float) as net_out,
    cast((l_partkey*13 % 4300) + l_tax as float) as disk_io
  from lineitem
)"""


def _pair_ctes(a: str, b: str, source: str | None = None, window: int = WINDOW_SECONDS) -> str:
    """Rounded inputs, pair join, bounds, starts, servers and spine (literal form)."""
    return f"""with {source or TELEMETRY},
  ta as (select ts, server_id, {r2f(a)} as {a} from telemetry),
  tb as (select ts, server_id, {r2f(b)} as {b} from telemetry),
  j as (select ta.ts, ta.server_id, ta.{a}, tb.{b}
        from ta join tb on ta.ts = tb.ts and ta.server_id = tb.server_id),
  bounds as (select min(ts) as lo, max(ts) as hi from j),
  starts as (
    select unnest(generate_series(
      make_timestamp(cast(floor(epoch_us(lo) / {SLIDE_SECONDS * 1_000_000}) as bigint) * {SLIDE_SECONDS * 1_000_000}),
      hi, interval {SLIDE_SECONDS} second)) as ws
    from bounds),
  servers as (select distinct server_id from j),
  spine as (select s.server_id, st.ws, st.ws + interval {window} second as we
            from servers s, starts st)"""


def _case(x: str, y: str, tx: float, ty: float, both: str, only_x: str, only_y: str) -> str:
    X, Y = dbl(x), dbl(y)
    return (f"case when {X} > {dbl(tx)} and {Y} > {dbl(ty)} then '{both}' "
            f"when {X} > {dbl(tx)} and {Y} <= {dbl(ty)} then '{only_x}' "
            f"when {Y} > {dbl(ty)} and {X} <= {dbl(tx)} then '{only_y}' end")


def _cpu_mem_alerts(window: int = WINDOW_SECONDS) -> str:
    return _pair_ctes("cpu_pct", "mem_pct", window=window) + f""",
  agg as (
    select sp.server_id, sp.ws, sp.we,
      {r2d('avg(cast(j.cpu_pct as double))')} as avg_cpu,
      {r2d('avg(cast(j.mem_pct as double))')} as avg_mem
    from spine sp left join j
      on j.server_id = sp.server_id and j.ts >= sp.ws and j.ts < sp.we
    group by sp.server_id, sp.ws, sp.we)
select server_id, strftime(ws, '%H:%M:%S') as window_start, strftime(we, '%H:%M:%S') as window_end,
  avg_cpu, avg_mem,
  {_case('avg_cpu', 'avg_mem', CPU_THRESHOLD, MEM_THRESHOLD, ALERT_CPU_MEM_BOTH, ALERT_CPU_ONLY, ALERT_MEM_ONLY)} as alert
from agg order by server_id, ws"""

def _net_disk_alerts(source: str | None = None, window: int = WINDOW_SECONDS) -> str:
    return _pair_ctes("net_in", "disk_io", source, window) + f""",
  agg as (
    select sp.server_id, sp.ws, sp.we,
      {r2f('max(j.net_in)')} as max_net_in,
      {r2f('max(j.disk_io)')} as max_disk_io
    from spine sp left join j
      on j.server_id = sp.server_id and j.ts >= sp.ws and j.ts < sp.we
    group by sp.server_id, sp.ws, sp.we)
select server_id, strftime(ws, '%H:%M:%S') as window_start, strftime(we, '%H:%M:%S') as window_end,
  max_net_in, max_disk_io,
  {_case('max_net_in', 'max_disk_io', NET_IN_THRESHOLD, DISK_IO_THRESHOLD, ALERT_NET_DISK_BOTH, ALERT_NET_ONLY, ALERT_DISK_ONLY)} as alert
from agg order by server_id, ws"""


CPU_MEM_ALERTS = _cpu_mem_alerts()
NET_DISK_ALERTS = _net_disk_alerts()


# --------------------------------------------------------------------------- ingest side

# DuckDB strftime equivalents of the event feed's timestamp styles, same order.
DUCK_TS_STYLES = (
    "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')",
    "strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:30'",
    "strftime(ts, '%H:%M:%S')",
    "'  ' || strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || ' '",
    "strftime(ts, '%-H:%M:%S')",
    "strftime(ts, '%Y-%m-%d')",
)


def norm_hms(x: str) -> str:
    """HH:MM:SS normalisation written with DuckDB string functions."""
    t = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    after = (f"(case when contains({t}, 'T') then string_split({t}, 'T')[-1] "
             f"when contains({t}, ' ') then string_split({t}, ' ')[-1] else {t} end)")
    part = f"split_part(split_part(regexp_replace({after}, 'Z$', ''), '.', 1), '+', 1)"

    def colons(e):
        return f"(length({e}) - length(replace({e}, ':', '')))"
    return (f"(case when length({t}) = 8 and {colons(t)} = 2 then {t} "
            f"when length({part}) >= 8 and {colons(part)} >= 2 then substr({part}, 1, 8) "
            f"else {t} end)")


def _cents(x: str) -> str:
    c = f"cast(round({x}) as bigint)"
    return f"(cast({c} // 100 as varchar) || '.' || lpad(cast({c} % 100 as varchar), 2, '0'))"


WIDE = f"""
wide as (
  select strftime({TS}, '%Y-%m-%d %H:%M:%S') as ts,
    {SERVER} as server_id,
    {_cents('case when l_suppkey % 2 = 0 then 8000 + l_quantity*40 else l_quantity*100 end')} as cpu_pct,
    {_cents('case when l_suppkey % 3 = 0 then 8000 + (l_partkey % 50)*40 else (l_partkey % 80)*100 end')} as mem_pct,
    {_cents('round(l_extendedprice*100/14)')} as net_in,
    {_cents('round(l_extendedprice*100/20)')} as net_out,
    {_cents('(l_partkey*13 % 4300)*100 + round(l_tax*100)')} as disk_io
  from lineitem
)"""


def _fields(m):
    return ["ts", "server_id", m.column, *m.extra_columns]


def _msg_json(m) -> str:
    parts = []
    for i, f in enumerate(_fields(m)):
        parts.append(f"'{'{' if i == 0 else ','}\"{f}\":\"' || {f} || '\"'")
    return " || ".join(parts) + " || '}'"


def _msg_csv(m) -> str:
    return " || ',' || ".join(_fields(m))


def _split(fmt: str) -> str:
    enc = _msg_json if fmt == "json" else _msg_csv
    return "\n  union all ".join(f"select '{m.topic}' as topic, {enc(m)} as value from wide" for m in METRICS)


SPLIT_JSON = f"with {WIDE}\n{_split('json')}"
SPLIT_CSV = f"with {WIDE}\n{_split('csv')}"
TOPIC_COUNTS = f"with {WIDE}, s as ({_split('csv')})\nselect topic, count(*) as messages from s group by topic"


def _unpivot(metrics, extra_cols: str = "") -> str:
    sel = []
    for m in metrics:
        v2 = f"cast({m.extra_columns[0]} as double)" if m.extra_columns else "cast(null as double)"
        sel.append(f"select '{m.topic}' as topic, '{m.name}' as metric, ts as ts_text, {norm_hms('ts')} as ts, "
                   f"server_id, cast({m.column} as double) as value, {v2} as value2{extra_cols} from wide")
    return "\n  union all ".join(sel)


DECODE = (f"with {WIDE}, d as ({_unpivot(METRICS)})\n"
          "select topic, metric, ts_text, ts, server_id, value, value2, false as skipped, "
          "cast(null as varchar) as reason from d")


def _status_cols(src: str = "d") -> str:
    thr = " ".join(f"when '{m.topic}' then {dbl(m.threshold)}" for m in METRICS)
    pre = " ".join(f"when '{m.topic}' then '{m.status_prefix}'" for m in METRICS)
    col = " ".join(f"when '{m.topic}' then '{m.column}'" for m in METRICS)
    extra = " ".join(f"when '{m.topic}' then ' | {m.extra_columns[0]}=' || cast(value2 as varchar)"
                     for m in METRICS if m.extra_columns)
    alert = f"coalesce(not isnan(value) and value > (case topic {thr} end), false)"
    status = f"(case when {alert} then (case topic {pre} end) || cast(value as varchar) else '{STATUS_OK}' end)"
    line = (f"'[' || metric || '] ' || ts || ' | ' || server_id || ' | ' || (case topic {col} end) || '=' "
            f"|| cast(value as varchar) || coalesce(case topic {extra} end, '') || ' | ' || {status}")
    return f"{alert} as is_alert, {status} as status, {line} as line"


def _status_query(metrics) -> str:
    return (f"with {WIDE}, d as ({_unpivot(metrics)})\n"
            f"select topic, metric, ts, server_id, value, value2, {_status_cols()} from d")


CPU_MEM_STATUS = _status_query([m for m in METRICS if m.name in ("CPU", "MEM")])
NET_DISK_STATUS = _status_query([m for m in METRICS if m.name in ("NET", "DISK")])


def _topic_case(key: str) -> str:
    return "case " + " ".join(f"when {key} % 4 = {i} then '{m.topic}'" for i, m in enumerate(METRICS)) + " end"


STYLED = "case " + " ".join(f"when event_id % 7 = {i} then {s}" for i, s in enumerate(DUCK_TS_STYLES)) + " end"

FEED = f"""
ev as (
  select event_id, user_id, event_type, props,
    case when event_type = 'click' and user_id % 7 = 0 then value * 1e6
         when event_type = 'click' and user_id % 7 = 1 then value / 1e6 else value end as value,
    {_topic_case('event_id')} as topic,
    {STYLED} as styled,
    'user-' || cast(user_id as varchar) as server
  from events),
fe as (
  select *,
    case topic {" ".join(f"when '{m.topic}' then '{m.name}'" for m in METRICS)} end as metric,
    case topic {" ".join(f"when '{m.topic}' then '{m.column}'" for m in METRICS)} end as vcol,
    topic = '{[m for m in METRICS if m.extra_columns][0].topic}' as has2,
    case when event_type = 'click' or (event_type = 'view' and user_id % 3 <> 0)
              or (event_type = 'purchase' and user_id % 2 = 0) then 'normal'
         when event_type = 'view' then 'skip'
         when event_type = 'signup' then 'props'
         when event_type = 'purchase' then 'null'
         when event_type = 'error' then case user_id % 4 when 0 then 'cut' when 1 then 'trail' when 2 then 'single' else 'suffix' end
         else 'normal' end as kind
  from ev),
fm as (
  select *,
    '{{"ts":"' || styled || '","server_id":"' || server || '","' || vcol || '":' || cast(value as varchar)
      || case when has2 then ',"{[m for m in METRICS if m.extra_columns][0].extra_columns[0]}":' || cast(value as varchar) else '' end || '}}' as normal_text,
    '{{"ts":"' || styled || '","server_id":"' || server || '","' || vcol || '":null'
      || case when has2 then ',"{[m for m in METRICS if m.extra_columns][0].extra_columns[0]}":null' else '' end || '}}' as null_text,
    '{{"ts":"' || styled || '","server_id":"' || server || '","' || vcol || '":"' || cast(value as varchar)
      || case when has2 then 'f","{[m for m in METRICS if m.extra_columns][0].extra_columns[0]}":"' || cast(value as varchar) else '' end || 'f"}}' as suffix_text
  from fe),
acc as (
  select event_id as "offset", topic, metric,
    case when kind = 'props' then '' else styled end as ts_text,
    case when kind = 'props' then ''
         when event_type = 'click' and user_id % 7 = 3 then '[''' || server || ''', {{''a'': 1.5, ''b'': None}}, True]'
         else server end as server_id,
    case when kind = 'props' then 0.0 else value end as value,
    case when has2 then (case when kind = 'props' then 0.0 else value end) end as value2
  from fm where kind in ('normal', 'props'))"""

EVENT_FEED_DECODE = (f"with {FEED},\n s as (select *, {norm_hms('ts_text')} as ts from acc)\n"
                     f"select \"offset\", topic, metric, ts, server_id, value, value2, {_status_cols()}, ts_text from s")

INGEST_REJECTS = f"""with {FEED}
select topic, event_id as "offset",
  case kind when 'cut' then substr(normal_text, 1, length(normal_text) - 1) when 'trail' then normal_text || ' trailing'
    when 'single' then replace(normal_text, '"', '''') when 'suffix' then suffix_text else null_text end as message,
  case when kind in ('null', 'suffix') then 'bad number' else 'malformed or not a JSON object' end as reason
from fm where kind not in ('normal', 'props', 'skip')"""

PROCESSED_COUNTS = f"with {FEED}\nselect topic, count(*) as processed from acc group by topic"

_CONSUMER = (f"case when topic in ('topic-cpu', 'topic-mem') then '{CONSUMER_GROUP_CPU_MEM}' "
             f"when topic in ('topic-net', 'topic-disk') then '{CONSUMER_GROUP_NET_DISK}' end")

ALERT_TOTALS = (f"with {FEED},\n s as (select *, {norm_hms('ts_text')} as ts from acc),\n"
                f" st as (select topic, {_status_cols()} from s)\n"
                f"select {_CONSUMER} as consumer, count(*) filter (where is_alert) as alerts from st group by 1")

PROGRESS_SNAPSHOT = (f"with {FEED},\n g as (select {_CONSUMER} as consumer, count(*) as total_processed, "
                     f"count(distinct topic) as topics_seen from acc group by 1)\n"
                     f"select consumer, total_processed, topics_seen, "
                     f"{r2d('cast(total_processed as double) / greatest(topics_seen, 1)')} as avg_per_topic from g")

NORMALISE_TS = (f"with e as (select event_id, {STYLED} as ts_text from events)\n"
                f"select event_id, ts_text, {norm_hms('ts_text')} as ts_hms from e")


def ingest_sql() -> dict[str, str]:
    return {
        "split_messages_json": SPLIT_JSON,
        "split_messages_csv": SPLIT_CSV,
        "topic_message_counts": TOPIC_COUNTS,
        "decode_messages_json": DECODE,
        "decode_messages_csv": DECODE,
        "cpu_mem_status": CPU_MEM_STATUS,
        "net_disk_status": NET_DISK_STATUS,
        "event_feed_decode": EVENT_FEED_DECODE,
        "ingest_rejects": INGEST_REJECTS,
        "processed_counts": PROCESSED_COUNTS,
        "alert_totals": ALERT_TOTALS,
        "progress_snapshot": PROGRESS_SNAPSHOT,
        "normalise_ts": NORMALISE_TS,
    }


# --------------------------------------------------------------------------- window views

FULL = "'%Y-%m-%d %H:%M:%S'"


def _joined(a, b):
    return _pair_ctes(a, b) + f"\nselect strftime(ts, {FULL}) as ts, server_id, {a}, {b} from j"


CPU_MEM_JOINED = _joined("cpu_pct", "mem_pct")
NET_DISK_JOINED = _joined("net_in", "disk_io")

WINDOW_BOUNDS = _pair_ctes("cpu_pct", "mem_pct") + f"""
select strftime(lo, {FULL}) as min_ts, strftime(hi, {FULL}) as max_ts,
  (select strftime(min(ws), {FULL}) from starts) as first_start,
  (select strftime(max(ws), {FULL}) from starts) as last_start,
  (select count(*) from starts) as n_starts
from bounds"""

WINDOW_STARTS = _pair_ctes("cpu_pct", "mem_pct") + f"""
select strftime(ws, {FULL}) as window_start, strftime(ws + interval {WINDOW_SECONDS} second, {FULL}) as window_end
from starts"""

SERVER_LIST = _pair_ctes("cpu_pct", "mem_pct") + "\nselect server_id from servers"

WINDOW_SPINE = _pair_ctes("cpu_pct", "mem_pct") + f"""
select server_id, strftime(ws, {FULL}) as window_start, strftime(we, {FULL}) as window_end from spine"""


def _nonempty(a, b, agg_a, agg_b, out_a, out_b, case_sql):
    per = -(-WINDOW_SECONDS // SLIDE_SECONDS)
    return _pair_ctes(a, b) + f""",
  x as (
    select server_id, {a}, {b},
      make_timestamp((cast(floor(epoch_us(ts) / {SLIDE_SECONDS * 1_000_000}) as bigint) - k) * {SLIDE_SECONDS * 1_000_000}) as ws
    from j, (select unnest(range({per})) as k)),
  agg as (select server_id, ws, {agg_a} as {out_a}, {agg_b} as {out_b} from x group by server_id, ws)
select server_id, strftime(ws, '%H:%M:%S') as window_start,
  strftime(ws + interval {WINDOW_SECONDS} second, '%H:%M:%S') as window_end,
  {out_a}, {out_b}, {case_sql} as alert
from agg"""


CPU_MEM_NONEMPTY = _nonempty(
    "cpu_pct", "mem_pct", r2d("avg(cast(cpu_pct as double))"), r2d("avg(cast(mem_pct as double))"),
    "avg_cpu", "avg_mem",
    _case("avg_cpu", "avg_mem", CPU_THRESHOLD, MEM_THRESHOLD, ALERT_CPU_MEM_BOTH, ALERT_CPU_ONLY, ALERT_MEM_ONLY))
NET_DISK_NONEMPTY = _nonempty(
    "net_in", "disk_io", r2f("max(net_in)"), r2f("max(disk_io)"), "max_net_in", "max_disk_io",
    _case("max_net_in", "max_disk_io", NET_IN_THRESHOLD, DISK_IO_THRESHOLD,
          ALERT_NET_DISK_BOTH, ALERT_NET_ONLY, ALERT_DISK_ONLY))

ALERT_SUMMARY = f"""
with u as (
  select 'cpu_mem' as job, alert from ({CPU_MEM_ALERTS}) a
  union all
  select 'net_disk' as job, alert from ({NET_DISK_ALERTS}) b)
select job, alert, count(*) as windows from u group by job, alert"""

INPUT_ROW_COUNTS = f"""with {TELEMETRY}
select 'cpu' as input, count(*) as rows from telemetry
union all select 'mem', count(*) from telemetry
union all select 'net', count(*) from telemetry
union all select 'disk', count(*) from telemetry"""


def window_sql() -> dict[str, str]:
    return {
        "cpu_mem_joined": CPU_MEM_JOINED,
        "net_disk_joined": NET_DISK_JOINED,
        "cpu_mem_joined_split": CPU_MEM_JOINED,
        "window_bounds": WINDOW_BOUNDS,
        "window_starts": WINDOW_STARTS,
        "server_list": SERVER_LIST,
        "window_spine": WINDOW_SPINE,
        "cpu_mem_windows_nonempty": CPU_MEM_NONEMPTY,
        "net_disk_windows_nonempty": NET_DISK_NONEMPTY,
        "cpu_mem_alerts_1h": _cpu_mem_alerts(3600),
        "net_disk_alerts_1h": _net_disk_alerts(window=3600),
        "alert_summary": ALERT_SUMMARY,
        "input_row_counts": INPUT_ROW_COUNTS,
    }


# --------------------------------------------------------------------------- file flow

# Telemetry as it arrives through the text files: the producer's two-decimal
# text parsed straight to float by the metric CSV scan.
TELEMETRY_FROM_TEXT = f"""{WIDE},
telemetry as (
  select strptime(ts, '%Y-%m-%d %H:%M:%S') as ts, server_id,
    cast(cpu_pct as float) as cpu_pct, cast(mem_pct as float) as mem_pct,
    cast(net_in as float) as net_in, cast(net_out as float) as net_out, cast(disk_io as float) as disk_io
  from wide
)"""


STREAM_PROGRESS_TOTALS = f"""with s as ({CPU_MEM_STATUS}),
  t as (select count(*) as processed, count(*) filter (where is_alert) as alerts, count(distinct topic) as topics_seen from s)
select processed, alerts, processed as total, cast(topics_seen as integer) as topics_seen,
  'Processed ' || processed || ' total messages | Avg per topic ≈ ' || printf('%.2f', cast(processed as double) / greatest(topics_seen, 1)) as line
from t"""


OFFSET_LEDGER = f"""with {WIDE}, s as ({_split('csv')}), n as (select topic, count(*) as n from s group by topic)
select {_CONSUMER} as consumer, topic, n as taken, n as offsets, cast(0 as bigint) as first_offset, n - 1 as last_offset, n as next_offset from n"""


def file_sql() -> dict[str, str]:
    return {
        "cpu_mem_alerts_via_csv": CPU_MEM_ALERTS,
        "net_disk_alerts_via_csv": _net_disk_alerts(TELEMETRY_FROM_TEXT),
        "stream_cpu_mem_status": CPU_MEM_STATUS,
        "stream_cpu_mem_windows": CPU_MEM_NONEMPTY,
        "stream_cpu_mem_alerts": CPU_MEM_ALERTS,
        "stream_net_disk_status": NET_DISK_STATUS,
        "stream_net_disk_windows": NET_DISK_NONEMPTY,
        "stream_topics_cpu_mem_alerts": CPU_MEM_ALERTS,
        "stream_topics_net_disk_alerts": _net_disk_alerts(TELEMETRY_FROM_TEXT),
        "incremental_cpu_mem_alerts": CPU_MEM_ALERTS,
        "incremental_net_disk_alerts": NET_DISK_ALERTS,
        "stream_late_corrected": CPU_MEM_ALERTS,
        "stream_dense_cpu_mem_alerts": CPU_MEM_ALERTS,
        "stream_dense_net_disk_alerts": NET_DISK_ALERTS,
        "stream_progress_totals": STREAM_PROGRESS_TOTALS,
        "offset_ledger": OFFSET_LEDGER,
    }


def all_sql() -> dict[str, str]:
    return {
        "cpu_mem_alerts": CPU_MEM_ALERTS,
        "net_disk_alerts": NET_DISK_ALERTS,
        **window_sql(),
        **ingest_sql(),
        **file_sql(),
    }
