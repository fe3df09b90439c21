"""Operators: DataFrames in, DataFrames out, every "now" a parameter."""
