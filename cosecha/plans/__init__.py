"""Analyses: each function takes canonical tables and returns a DataFrame."""
