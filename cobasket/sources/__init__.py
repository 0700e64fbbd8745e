"""Readers: sales CSV, shard datasets, tables, file listings, synthetic baskets."""
