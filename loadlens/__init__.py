"""Load-test analytics on Spark: logs, statistics and lag samples in, DataFrames out."""
