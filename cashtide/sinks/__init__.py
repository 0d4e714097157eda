"""Time-partitioned Parquet writers."""
