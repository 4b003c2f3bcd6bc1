"""Column expressions: k-mers, similarity, hashing, text parsing."""
