"""Trade-tape analytics on Spark: window statistics, anomaly labels, scoring and run metrics."""
