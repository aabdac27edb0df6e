"""Training-data operators: search, near duplicates, personal data, toxicity, extraction, mixing, packing, token files."""
