"""Column expressions and the vectorised helpers."""
