"""Sources of the tidemark library."""
