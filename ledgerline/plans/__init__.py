"""Analytics pipelines: plain functions from DataFrames to a DataFrame."""
