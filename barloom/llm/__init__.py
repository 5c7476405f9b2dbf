"""Operators for building language-model training data. Nothing else in the package imports this one."""
