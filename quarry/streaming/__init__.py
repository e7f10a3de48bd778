"""Structured Streaming forms of the file pipeline and landed-body parsing."""
