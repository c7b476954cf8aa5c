"""Incremental cubes by Structured Streaming."""
