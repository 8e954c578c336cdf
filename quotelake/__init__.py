"""Quote lakehouse jobs on Spark: layered tables, quality checks and reports."""
