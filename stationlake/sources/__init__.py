"""Sources and sinks: raw CSV, raw tables derived from the shared test data, parquet."""
