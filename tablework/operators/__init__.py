"""Operators over DataFrames; none of them collects its input."""
