"""Readers of the input formats, all with explicit schemas."""
