"""Training-data operators: mixing, archives, search, deduplication, extraction, tokens, toxicity."""
