"""Relational operators of the load and query paths."""
