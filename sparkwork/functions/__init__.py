"""Column expressions (all built-in Spark expressions)."""
