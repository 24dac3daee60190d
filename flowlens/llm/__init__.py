"""Operators for training-data corpora: fingerprints, joins, deduplication, scans, language models, mixing, encoding."""
