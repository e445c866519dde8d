"""Normalisers, marts and reports as functions from DataFrames to DataFrames."""
