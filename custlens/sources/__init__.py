"""Sources and sinks: parquet tables, JDBC, CSV folders, JSONL publishing."""
