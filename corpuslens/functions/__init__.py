"""Column helpers: every function maps Columns to a Column."""
