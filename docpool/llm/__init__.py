"""Training-data operators: token counts, deduplication, filters, media and token files."""
