"""Composed queries: staging models, star schema, daily aggregates, dashboard cards, pipeline."""
