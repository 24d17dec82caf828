"""Operators from DataFrames to DataFrames, for use with ``transform``."""
