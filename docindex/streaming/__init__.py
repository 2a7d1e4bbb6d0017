"""Structured Streaming forms of bulk writes and search."""
