"""Readers of dated files, canonical tables, and sinks."""
