"""Readers, tick mappings and writers."""
