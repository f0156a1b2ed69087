"""Behaviour analytics and recommendations on Spark DataFrames."""
