"""Independent SQL statements of every query, for DuckDB over the same parquet tables."""
