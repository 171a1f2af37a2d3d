"""Composed jobs: catalog, the daily run, and the query registry."""
