"""Readers: streams, lake tables and the derived raw feed."""
