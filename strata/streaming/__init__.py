"""Structured Streaming entry points (arrival-driven loading and daily rebuilds)."""
