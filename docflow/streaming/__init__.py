"""Structured Streaming forms of the incremental run and of the alert windows."""
