"""User-level jobs: star model, measures, report queries, gold/silver builders and the layer runner."""
