"""Incremental forms built on Structured Streaming file sources."""
