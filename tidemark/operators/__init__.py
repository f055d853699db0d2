"""Operators of the tidemark library."""
