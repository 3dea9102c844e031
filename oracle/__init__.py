"""Independent SQL oracles (DuckDB) and the comparison harness used by tests."""
