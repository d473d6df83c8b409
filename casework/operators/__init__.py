"""Operators: every function takes and returns DataFrames, nothing is collected."""
