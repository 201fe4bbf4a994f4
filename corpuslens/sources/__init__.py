"""Readers, record normalisers and writers."""
