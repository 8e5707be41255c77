"""Scalar column functions (built-in expressions only)."""
