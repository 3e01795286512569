"""Wattline: smart-meter feed analytics on Spark DataFrames and Structured Streaming."""
