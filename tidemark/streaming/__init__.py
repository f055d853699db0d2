"""Streaming of the tidemark library."""
