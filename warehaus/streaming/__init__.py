"""Incremental landing -> stage load with Structured Streaming.

The reference runs batch loads only; this package drives the same tolerant
stage load (``warehaus.sources.stage_load.parse_landing``) from newly
arriving landing files, with exactly-once file tracking in a checkpoint.
"""
