"""Sequence and expression analytics on Spark DataFrames."""
