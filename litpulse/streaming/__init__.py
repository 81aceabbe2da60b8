"""Structured Streaming ingest of landed pages."""
