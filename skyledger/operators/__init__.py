"""Operators over DataFrames, grouped by kind."""
