"""Utility mining and utility-weighted recommendation on Spark DataFrames."""
