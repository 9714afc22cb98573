"""turnmill: coding-session traces to conversation datasets, on Spark DataFrames."""

__version__ = "0.1.0"
