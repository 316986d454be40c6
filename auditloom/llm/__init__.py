"""Training-data operators: archives, deduplication, mixing, scoring, tokens."""
