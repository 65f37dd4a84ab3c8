"""connlens: connection-record analytics as plain Spark DataFrame jobs.

Sub-packages
------------
sources    scans, sinks and the fixture views over the driver tables
functions  scalar column expressions (strings, math, arrays, json, hashing)
operators  table-level operators (quality, labels, features, sampling,
           metrics, curves, neighbours, anomaly scoring, models, traffic windows)
plans      composed report queries and the query registry used by the driver
streaming  Structured Streaming jobs (windows, dedup, scoring, stateful last-N)
"""

__version__ = "0.1.0"
