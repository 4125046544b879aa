"""Lazy operators from DataFrames to a DataFrame."""
