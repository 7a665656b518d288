"""Podium: feature tables from event results and a reference dimension, on Spark.

Batch lake and Structured Streaming jobs share the same DataFrame operators.
"""
