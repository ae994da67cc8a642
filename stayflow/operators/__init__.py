"""Operators: DataFrames in, DataFrames out; lazy unless they check their input."""
