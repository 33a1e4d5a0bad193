"""Distributed operators on DataFrames."""
