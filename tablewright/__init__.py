"""Tabular analytics on Spark DataFrames."""
