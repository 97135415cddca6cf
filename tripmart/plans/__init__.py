"""Query plans: the 20 business questions, the registry of queries checked
against DuckDB, and the DuckDB statements themselves."""
