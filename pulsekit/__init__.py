"""Pulse-synchronous channel data on Spark DataFrames, in batch and streaming."""
