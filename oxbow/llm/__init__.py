"""Training-data pipeline operators (token counts, dedup, filters, mixing, WARC, BPE)."""
