"""Gridded-climate analytics on Spark DataFrames."""
