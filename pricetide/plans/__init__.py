"""Query catalogue: SQL variants, the registry used by ``__spark_entry__`` and
the DuckDB oracle texts."""
