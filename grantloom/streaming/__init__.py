"""Structured Streaming over the landing folder."""
