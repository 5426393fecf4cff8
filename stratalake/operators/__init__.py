"""DataFrame operators: quality, incremental load, dedup, upsert, keys, star, lookups."""
