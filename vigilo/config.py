"""Job parameters: thresholds, window geometry, topics and alert texts.

Everything here is a small literal; the jobs take a config object so that
callers can override any knob (paths, thresholds, window, slide).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must equal the monitored pipeline's own constants for
# results to agree; they are stated here once, in natural order.
# ---------------------------------------------------------------------------
CPU_THRESHOLD = 89.65
MEM_THRESHOLD = 89.73
NET_IN_THRESHOLD = 7205.16
DISK_IO_THRESHOLD = 4220.24

WINDOW_SECONDS = 30
SLIDE_SECONDS = 10

TOPIC_CPU = "topic-cpu"
TOPIC_MEM = "topic-mem"
TOPIC_NET = "topic-net"
TOPIC_DISK = "topic-disk"

ALERT_CPU_MEM_BOTH = "High CPU + Memory stress"
ALERT_CPU_ONLY = "CPU spike suspected"
ALERT_MEM_ONLY = "Memory saturation suspected"
ALERT_NET_DISK_BOTH = "Network flood + Disk thrash suspected"
ALERT_NET_ONLY = "Possible DDoS"
ALERT_DISK_ONLY = "Disk thrash suspected"

STATUS_CPU_PREFIX = "⚠ CPU ALERT: "
STATUS_MEM_PREFIX = "⚠ MEM ALERT: "
STATUS_NET_PREFIX = "⚠ NET_IN ALERT: "
STATUS_DISK_PREFIX = "⚠ DISK_IO ALERT: "
STATUS_OK = "OK"

WIDE_COLUMNS = ("ts", "server_id", "cpu_pct", "mem_pct", "net_in", "net_out", "disk_io")

CONSUMER_GROUP_CPU_MEM = "consumer1-cpu-mem"
CONSUMER_GROUP_NET_DISK = "consumer2-net-disk"
DEFAULT_TEAM_NO = "103"

RESULT_NAME_FORMAT = "team_{team_no}_{label}.csv"
STATUS_LINE_FORMAT = "[{metric}] {ts} | {server_id} | {figures} | {status}"
FIGURE_FORMAT = "{name}={value}"
FIGURE_SEPARATOR = " | "
PROGRESS_FORMAT = "Processed {total} total messages | Avg per topic ≈ {avg:.2f}"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class MetricSpec:
    """One metric carried by one topic."""

    name: str            # short name used in status lines, e.g. "CPU"
    topic: str
    column: str          # value column in the typed table
    threshold: float
    status_prefix: str
    extra_columns: tuple[str, ...] = ()   # carried but never thresholded (net_out)


CPU = MetricSpec("CPU", TOPIC_CPU, "cpu_pct", CPU_THRESHOLD, STATUS_CPU_PREFIX)
MEM = MetricSpec("MEM", TOPIC_MEM, "mem_pct", MEM_THRESHOLD, STATUS_MEM_PREFIX)
NET = MetricSpec("NET", TOPIC_NET, "net_in", NET_IN_THRESHOLD, STATUS_NET_PREFIX, ("net_out",))
DISK = MetricSpec("DISK", TOPIC_DISK, "disk_io", DISK_IO_THRESHOLD, STATUS_DISK_PREFIX)

METRICS: tuple[MetricSpec, ...] = (CPU, MEM, NET, DISK)
METRIC_BY_TOPIC = {m.topic: m for m in METRICS}


@dataclass(frozen=True)
class WindowSpec:
    """Sliding window geometry in whole seconds; windows are [start, start + length)."""

    length_s: int = WINDOW_SECONDS
    slide_s: int = SLIDE_SECONDS

    def validate(self) -> "WindowSpec":
        if self.length_s <= 0 or self.slide_s <= 0:
            raise ValueError("window length and slide must be positive")
        if self.length_s < self.slide_s:
            raise ValueError("a window shorter than its slide would leave samples out")
        # Window starts are aligned by flooring the second-of-minute to the
        # slide; that equals flooring epoch seconds only when the slide
        # divides a minute.
        if 60 % self.slide_s != 0:
            raise ValueError(f"slide {self.slide_s}s must divide 60 seconds")
        return self

    @property
    def per_sample(self) -> int:
        """Upper bound on windows one sample can fall into."""
        return -(-self.length_s // self.slide_s)


@dataclass(frozen=True)
class PairJobSpec:
    """A two-metric windowed alert job (CPU+MEM averages, NET+DISK maxima)."""

    first: MetricSpec
    second: MetricSpec
    how: str                 # "avg" or "max"
    out_first: str           # output column names
    out_second: str
    alert_both: str
    alert_first: str
    alert_second: str
    label: str               # file suffix, e.g. "CPU_MEM"
    window: WindowSpec = field(default_factory=WindowSpec)


CPU_MEM_JOB = PairJobSpec(
    CPU, MEM, "avg", "avg_cpu", "avg_mem",
    ALERT_CPU_MEM_BOTH, ALERT_CPU_ONLY, ALERT_MEM_ONLY, "CPU_MEM",
)
NET_DISK_JOB = PairJobSpec(
    NET, DISK, "max", "max_net_in", "max_disk_io",
    ALERT_NET_DISK_BOTH, ALERT_NET_ONLY, ALERT_DISK_ONLY, "NET_DISK",
)


def output_name(team_no: str, job: PairJobSpec) -> str:
    """Result name the batch jobs write (``RESULT_NAME_FORMAT``)."""
    return RESULT_NAME_FORMAT.format(team_no=team_no, label=job.label)
