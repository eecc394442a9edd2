"""Independent DuckDB recomputation of the registered queries (test oracle)."""
