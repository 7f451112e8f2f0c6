"""Relationship-graph analytics on Spark DataFrames."""
