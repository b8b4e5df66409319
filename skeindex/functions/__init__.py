"""Column expressions and the small per-row helpers used inside Spark tasks."""
