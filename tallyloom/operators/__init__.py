"""Operators: DataFrames and parameters in, one DataFrame out."""
