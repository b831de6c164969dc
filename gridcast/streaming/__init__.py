"""Incremental versions of the daily jobs on Structured Streaming."""
