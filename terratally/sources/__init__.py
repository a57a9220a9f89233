"""Readers and writers: delimited drops, city reference, Parquet warehouse, testbed views."""
