"""Dialogue analytics on Spark DataFrames."""
