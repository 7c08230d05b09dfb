"""Column expressions: casting, clock arithmetic and distances."""
