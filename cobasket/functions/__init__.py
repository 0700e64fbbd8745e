"""Column-expression helpers (no Python UDFs)."""
