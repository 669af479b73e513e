"""Incremental application of change feeds with Structured Streaming."""
