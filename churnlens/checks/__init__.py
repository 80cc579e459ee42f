"""DuckDB oracle SQL for the driver's side-by-side correctness check."""
