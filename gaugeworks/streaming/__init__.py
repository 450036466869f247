"""Structured Streaming over append-only timelines."""
