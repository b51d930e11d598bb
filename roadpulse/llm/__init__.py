"""Training-data operators: scoring, deduplication, tokenising and decontamination of texts."""
