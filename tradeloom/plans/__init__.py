"""Models, checks and reports as functions from DataFrames to DataFrames."""
