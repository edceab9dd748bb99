"""Offline search analytics on Spark DataFrames."""
