"""Vessel-trajectory analytics on Spark DataFrames."""
