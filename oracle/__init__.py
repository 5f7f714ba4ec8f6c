"""Independent SQL for checking the Spark results in DuckDB."""
