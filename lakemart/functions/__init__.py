"""Column expressions built from Spark built-in functions."""
