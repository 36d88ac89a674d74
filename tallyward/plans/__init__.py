"""The reports: pure functions from DataFrames and typed parameters to DataFrames."""
