"""Functions of the tidemark library."""
