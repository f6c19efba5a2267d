"""Column-level helpers (built-in Spark expressions only; no Python UDFs)."""
