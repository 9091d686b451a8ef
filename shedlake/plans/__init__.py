"""Whole-lake wiring and the query registry."""
