"""Column functions ``f(col, ...) -> Column``; all are built-in Spark expressions (no Python UDFs)."""
