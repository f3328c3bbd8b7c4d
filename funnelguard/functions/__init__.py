"""Column expressions and reusable plan fragments: time windows, exact sums, robust statistics."""
