"""Training-data operators: extraction, filtering, dedup, scanning, packing, search, tokenising."""
