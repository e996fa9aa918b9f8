"""DataFrame-to-DataFrame operators and aggregate building blocks."""
