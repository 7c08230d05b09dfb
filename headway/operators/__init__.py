"""DataFrame-to-DataFrame building blocks and table writers."""
