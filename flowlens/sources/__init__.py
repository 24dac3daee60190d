"""Readers and writers: Parquet splits, fitted artifacts, event JSON, Kafka options."""
