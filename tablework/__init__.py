"""Layered-data operators for Spark: every operator takes and returns DataFrames."""
