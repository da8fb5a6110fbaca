"""Training-data operators: sharding, near duplicates, packing, mixing, search, fingerprints, language, PII, licences, tokens."""
