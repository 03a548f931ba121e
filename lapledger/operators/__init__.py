"""Operators: DataFrames and column names in, DataFrame out, nothing run until a sink."""
