"""Training-data pipeline operators: quality, extraction, tokenising, dedup, privacy, mixing, archives."""
