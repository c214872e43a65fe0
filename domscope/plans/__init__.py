"""Stages: pure functions from DataFrames to DataFrames."""
