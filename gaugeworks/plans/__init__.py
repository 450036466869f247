"""Plans over a graph of tables."""
