"""The jobs' building blocks: each maps DataFrames to a DataFrame."""
