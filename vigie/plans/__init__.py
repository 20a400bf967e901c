"""Plans: pipelines of steps, model specifications, the model run, list and
threshold workflows, and the registered queries with their DuckDB oracles."""
