"""Table writes: replace, partitioned, upsert, versions."""
