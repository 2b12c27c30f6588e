"""The models, as functions from DataFrames to DataFrames."""
