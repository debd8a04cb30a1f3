"""Training-data operators: search, mixing, filtering, deduplication, tokens."""
