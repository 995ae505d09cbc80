"""Training-data operators: dedup, search, tokenising, mixing, quality, privacy."""
