"""Composed jobs, and the registry of queries with their SQL oracles."""
