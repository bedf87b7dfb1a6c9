"""Sources and sinks: given tables, fixtures, snapshot extract, landing CSV, stage load."""
