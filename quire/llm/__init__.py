"""Operators of a training-data pipeline: one module each, and the queries that apply them to whole tables."""
