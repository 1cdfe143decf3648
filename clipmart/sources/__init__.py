"""Readers and writers: parquet lake tables partitioned by client, CSV
seeds, JSON event logs, binary landing objects."""
