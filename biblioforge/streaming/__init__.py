"""Incremental forms of batch operators, on Structured Streaming."""
