"""Training-data operators: language id, quality, token counts, near and exact duplicates,
mixing, substring duplicates, BPE, personal data. Nothing else in the library imports this."""
