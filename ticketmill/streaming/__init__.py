"""Structured Streaming entry points; all of them drain what is there and stop."""
