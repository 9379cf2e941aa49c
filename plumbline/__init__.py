"""Listing integration, quality and agreement analytics on Spark DataFrames."""
