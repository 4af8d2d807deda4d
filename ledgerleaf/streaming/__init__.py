"""Structured Streaming sources, per-batch jobs and window counts."""
