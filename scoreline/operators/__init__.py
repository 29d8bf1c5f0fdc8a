"""Operators on DataFrames: shape, filter, join, aggregate, order, sample, measure."""
