"""Named queries (catalog), their DuckDB oracles and plan inspection."""
