"""Query registry (Spark) and oracle SQL (DuckDB)."""
