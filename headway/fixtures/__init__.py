"""Transit-shaped inputs derived from the benchmark tables."""
