"""Graph, search and file outputs."""
