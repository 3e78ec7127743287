"""Training-data operators: deduplication, decontamination, archives, quality, search, filters, tokens."""
