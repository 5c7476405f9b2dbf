"""Operators: each takes a DataFrame of bars and returns a DataFrame."""
