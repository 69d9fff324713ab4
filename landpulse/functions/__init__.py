"""Column expressions: spectral indices, scores, labels."""
