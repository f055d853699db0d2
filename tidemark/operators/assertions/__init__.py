"""Table assertions. Each takes DataFrames and returns the failing rows or groups."""
