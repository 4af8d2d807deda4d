"""Readers. All return lazy DataFrames; only header lines reach the driver."""
