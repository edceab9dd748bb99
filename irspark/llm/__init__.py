"""Operators of a training-data pipeline, with the queries that apply them to whole tables."""
