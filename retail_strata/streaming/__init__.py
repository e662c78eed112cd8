"""Structured Streaming form of the incremental step."""
