"""Match and player analytics as plain functions from DataFrames to DataFrames."""
