"""Structured Streaming entry points (S11s)."""
