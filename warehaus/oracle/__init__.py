"""Independent SQL formulations (DuckDB dialect) used as correctness oracles."""
