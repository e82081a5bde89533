"""Document analytics on Spark: extraction, layout, verification and publishing as DataFrame operations."""
