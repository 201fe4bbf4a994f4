"""Composed plans that chain several operators."""
