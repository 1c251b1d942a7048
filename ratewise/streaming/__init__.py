"""Structured Streaming scoring of incoming reviews."""
