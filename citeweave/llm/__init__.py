"""Operators that prepare training data: duplicates, fingerprints, shards, tokens, languages, secrets, packing."""
