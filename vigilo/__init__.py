"""vigilo — Spark-native server-metric alerting.

Wide CPU / memory / network / disk records are split into per-metric messages,
decoded and normalised (batch or Structured Streaming) with per-message
threshold alerts, and paired metrics are aggregated over dense sliding windows
and classified into alerts. Everything is DataFrame operations over built-in
functions.
"""

__version__ = "0.1.0"
