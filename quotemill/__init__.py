"""Equity screening and scoring on Spark DataFrames."""

__version__ = "0.1.0"
