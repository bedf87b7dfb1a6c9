"""Column-expression functions (JVM-side, no Python UDFs)."""
