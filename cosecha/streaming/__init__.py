"""Structured Streaming over daily files and events."""
