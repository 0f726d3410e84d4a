"""Training-data operators: search, scoring, deduplication, decontamination, packing and archiving."""
