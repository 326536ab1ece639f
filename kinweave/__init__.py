"""Kinweave: a directed friendship graph kept and queried with Spark DataFrames."""
