"""Structured Streaming loader."""
