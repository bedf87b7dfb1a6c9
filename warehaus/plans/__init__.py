"""Compositions: per-table warehouse loads, table storage, the batch runner, the query catalog."""
