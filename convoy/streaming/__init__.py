"""Structured Streaming jobs. Every query keeps its checkpoint in a folder the caller names."""
