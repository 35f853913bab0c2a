"""Operators for training-data corpora: deduplication, joins, filters, models and encodings over document tables."""
