"""End-to-end plans: the customer-segment table (C8) and the registry of
named queries checked against DuckDB."""
