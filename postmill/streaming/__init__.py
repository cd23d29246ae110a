"""Structured Streaming: landing, draining and loading posts."""
