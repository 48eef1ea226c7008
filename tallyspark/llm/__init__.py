"""Training-data operators: deduplication, quality, packing, language, secrets, personal data, decontamination, chat."""
