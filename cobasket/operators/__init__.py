"""DataFrame operators: cleaning, co-occurrence, bucketing, dedup, quality checks."""
