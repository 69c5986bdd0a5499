"""Operators on DataFrames.  Each returns a DataFrame and does no action."""
