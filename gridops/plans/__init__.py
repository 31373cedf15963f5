"""Plans: the model graph wiring, the query registry and the DuckDB oracles."""
