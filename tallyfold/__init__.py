"""Metric updates to keyed state, on Spark DataFrames.

Updates (gauges and counters) are read, judged and folded into one row per
``(name, metric_type)``; lookups, listings, snapshots, outgoing batches and
audit events are derived from that state, in batch and as a stream.
"""
