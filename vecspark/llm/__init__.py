"""Training-data pipeline operators (language id, near-dedup, filters, tokenizers, PII, decontamination)."""
