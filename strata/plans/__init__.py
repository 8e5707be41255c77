"""Composite plans: silver/gold models, report queries, registered queries and oracles."""
