"""Incremental file pickup on Structured Streaming."""
