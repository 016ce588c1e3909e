"""Survey analytics on Spark: clean, transform, gate, publish, report."""
