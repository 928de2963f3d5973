"""Independent SQL twins of the registered queries, for DuckDB over the same tables."""
