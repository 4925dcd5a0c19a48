"""Training-data operators: language, duplicates, quality, leaks, tokens, toxicity, vectors, pages."""
