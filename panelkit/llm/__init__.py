"""Training-data operators: language ID, toxicity, token counts, chat, dedup, mixing, BPE, PII."""
