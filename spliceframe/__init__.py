"""Isoform analytics on Spark DataFrames in long format."""
