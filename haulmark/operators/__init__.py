"""The data work: every function takes DataFrames and returns a DataFrame."""
