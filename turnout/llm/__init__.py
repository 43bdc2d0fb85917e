"""Training-data operators: tokenising, extraction, quality, privacy, de-duplication and decontamination."""
