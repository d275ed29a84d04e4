"""meterline: a PySpark engine for machine event telemetry.

Landing files -> canonical event log -> sessions -> rule checks ->
quarantine -> curated sessions with a running balance. Every operator is
a function from DataFrame to DataFrame built on Spark's own windows,
joins and aggregates.
"""

__version__ = "0.1.0"
