"""Relational operators: flatten, rating, ranking, semantic joins, data tests, summaries."""
