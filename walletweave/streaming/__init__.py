"""Structured Streaming extension: captured blocks as a stream. An extension, not parity."""
