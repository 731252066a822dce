"""Training-data operators: quality, search, near and substring dedup, mixing, token files, licences, LM, PII, leaks."""
