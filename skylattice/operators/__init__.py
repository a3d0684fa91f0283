"""Loads, merges, quality checks and reports over DataFrames."""
