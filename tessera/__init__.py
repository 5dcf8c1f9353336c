"""Corpus curation on Spark: typed documents in, scored, cleaned, deduplicated, packed training data out."""
