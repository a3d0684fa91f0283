"""Staging, intermediate and mart models as lazy DataFrames."""
