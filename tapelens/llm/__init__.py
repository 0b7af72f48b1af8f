"""Training-data operators: deduplication, language, quality, tokens, mixing, scoring."""
