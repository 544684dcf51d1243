"""Collaborative-filtering analytics on Spark DataFrames."""
