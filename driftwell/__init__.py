"""Cleaning, profiling, drift, scoring and model-quality jobs over Spark DataFrames."""

__version__ = "0.1.0"
