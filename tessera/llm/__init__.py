"""Training-data operators: scoring, filtering, deduplication, encoding, archiving and packing of documents."""
