"""Composed jobs: the car configuration, the feature pipeline, training, scoring, model selection
and the registered queries (with their DuckDB oracles)."""
