"""Query plans: registered queries, their DuckDB reference SQL, and batch jobs."""
