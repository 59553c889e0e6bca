"""runlens: scheduled-job telemetry on Spark.

Discover jobs from their version history, flatten job and run payloads,
load runs and tasks incrementally with keyed upserts, join them into one
run-detail table and report on it. Every operator takes and returns
DataFrames.
"""

__version__ = "0.1.0"
