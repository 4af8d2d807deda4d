"""Operators of a training-data pipeline: scans, dedup, scoring, mixing, encoding."""
