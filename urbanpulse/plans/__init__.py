"""Query plans: processed jobs, driver-table stand-ins, the query registry and
its DuckDB oracle SQL."""
